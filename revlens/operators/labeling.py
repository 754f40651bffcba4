"""Merge, clean and label reviews.

`label_reviews` is one lazy plan: scan, join, clean, three labelers and the
vote all stay in a single projection pipeline after the join - the labels
are columns of the same rows, so no positional re-join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import compute_once
from ..functions import labels as LB
from ..functions import lexicon as LX
from ..functions.text import word_tokens
from . import clean as C
from .skew import spread_join

# Columns kept after the merge.  WIDE is what the downstream consumers need;
# NARROW is the published pipeline's column list (compatibility option).
WIDE = ["row_id", "text", "rating", "product_title", "store", "price", "helpful_vote",
        "main_category", "parent_asin", "timestamp", "verified_purchase"]
NARROW = ["text", "rating", "product_title", "store", "price", "helpful_vote"]


def merge_reviews(reviews: DataFrame, metadata: DataFrame, keep: list[str] | None = None,
                  null_safe: bool = False, hot_one_in: int | None = None) -> DataFrame:
    """J1 (+P1, P2, P3): rename the two `title` columns, inner-join on
    parent_asin, drop rows without text or rating, keep ``keep``.

    ``null_safe=True`` also matches a null key to a null key, as a pandas
    merge does.  With ``hot_one_in`` products that hold one in so many
    reviews are found by a sketch and spread over tasks (batch input only);
    else a hot product is left to adaptive skew-join splitting.
    """
    keep = keep or WIDE
    r = reviews.withColumnRenamed("title", "review_title")
    m = metadata.withColumnRenamed("title", "product_title")
    mcols = [c for c in m.columns if c != "parent_asin" and c not in r.columns]
    m = m.select("parent_asin", *mcols)
    if hot_one_in and not null_safe:
        ids = ["row_id"] if "row_id" in r.columns else None
        j = spread_join(r, m, "parent_asin", by=ids, one_in=hot_one_in)
    elif null_safe:
        j = r.join(m.withColumnRenamed("parent_asin", "_m_asin"),
                   r.parent_asin.eqNullSafe(F.col("_m_asin")), "inner").drop("_m_asin")
    else:
        j = r.join(m, "parent_asin", "inner")
    return _kept(j, keep)


def _kept(merged: DataFrame, keep: list[str] | None) -> DataFrame:
    """Merged rows with text and rating, reduced to ``keep``."""
    merged = C.drop_null(merged, ["text", "rating"])
    return merged.select(*[c for c in keep or WIDE if c in merged.columns])


def add_labels(df: DataFrame, text_col: str = "cleaned_text") -> DataFrame:
    """The three weak labels and the majority vote as columns.  The
    text is cut into tokens once for both lexicon scorers."""
    verified = "verified_purchase" if "verified_purchase" in df.columns else None
    helpful = "helpful_vote" if "helpful_vote" in df.columns else None
    out = df.withColumn("heuristic_sentiment", LB.heuristic_sentiment("rating", verified, helpful))
    out = compute_once(out, _tokens=word_tokens(text_col))
    out = compute_once(out, _a=LX.grade_sum("_tokens"), _b=LX.polarity_sum("_tokens"))
    out = out.withColumns({"lexicon_a_sentiment": LX.sentiment_a(F.col("_a")),
                           "lexicon_b_sentiment": LX.sentiment_b(F.col("_b"))}).drop("_tokens", "_a", "_b")
    return out.withColumn("final_sentiment", LB.majority_vote(
        "heuristic_sentiment", "lexicon_a_sentiment", "lexicon_b_sentiment"))


def label_reviews(reviews: DataFrame, metadata: DataFrame, keep: list[str] | None = None,
                  compat: bool = False) -> DataFrame:
    """The end-to-end labeled table.

    ``compat=True`` follows the published DAG: narrow column list (so the
    verified flag is gone before the rating rule), null-safe merge.
    """
    keep = keep or (NARROW if compat else WIDE)
    return _labeled(merge_reviews(reviews, metadata, keep=keep, null_safe=compat))


def label_merged(merged: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """L6 from reviews that carry their product's metadata already."""
    return _labeled(_kept(merged, keep))


def _labeled(merged: DataFrame) -> DataFrame:
    cleaned = C.strip_html_tags(merged, "text", "cleaned_text")
    cleaned = C.drop_urls(cleaned)
    cleaned = C.drop_file_names(cleaned)
    cleaned = C.drop_missing_text(cleaned.drop("text"))
    return add_labels(cleaned, "cleaned_text")
