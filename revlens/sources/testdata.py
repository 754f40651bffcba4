"""Adapter from the driver's test tables to review roles.

The test tables hold no reviews, so each role is derived once, here, with
deterministic rules (the DuckDB oracle builds the same views in
`revlens.plans.sqlviews`):

- products / categories  <- part      (p_name titles, p_type categories)
- numeric reviews        <- lineitem  (rating, votes, verified flag, ship date)
- text reviews           <- documents (doc_id is the row id)
- product metadata       <- part      (parent_asin = p_partkey as text)
- raw HTML               <- pages
- live review stream     <- events
- model evaluation       <- labels joined to documents
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.labels import argmax, heuristic_sentiment
from .io import read_positions

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# --- fixed values of the adapter --------------------------------------------
# Review timestamps of the text reviews: base epoch ms and step per doc_id.
TEXT_REVIEW_EPOCH_MS = 1_577_836_800_000
TEXT_REVIEW_STEP_MS = 3_600_000
# Phrases put before the review texts, by doc_id, so that the labelers differ.
REVIEW_PHRASES = ["", "very good", "not good", "the best", "really bad", "never great", "cheap but fine",
                  "not very happy", "awful", "works well", "hardly broken"]
# Every so many ids, one of these texts instead of the document's.
ODD_STEP = 13
ODD_TEXTS = ["https://shop.example.com/item", "photo_01.jpg", "N/A", "", "null", "http://a.example",
             "caf&eacute; &amp; bar &#8217;s <b title='a>b'>great</b>", "  "]
# Multiplier spreading doc ids over product keys (parent_asin).
DOC_TO_PRODUCT_STRIDE = 37
# -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 on `part`: one row per p_type, id by first appearance (lowest key).
    One row per category: the window runs over the tiny grouped table."""
    first = (table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("category_name"))
             .agg(F.min("p_partkey").alias("_first")))
    w = Window.orderBy("_first", "category_name")
    return first.select(F.row_number().over(w).cast("long").alias("category_id"), "category_name")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension with its category id (and store, for stratified sampling)."""
    part = table(spark, sf_dir, "part")
    return (part.join(categories(spark, sf_dir), part.p_type == F.col("category_name"))
                .select(F.col("p_partkey").alias("product_id"), "category_id",
                        F.col("p_name").alias("product_title"),
                        F.col("p_retailprice").alias("price"),
                        F.col("p_partkey").cast("string").alias("parent_asin"),
                        F.col("p_brand").alias("store")))


def review_facts(spark: SparkSession, sf_dir: str, row_ids: bool = False) -> DataFrame:
    """Numeric reviews from `lineitem`, labelled with the rating rule (L1);
    with ``row_ids`` their place in the table's files as ``row_id``."""
    path = f"{sf_dir.rstrip('/')}/lineitem.parquet"
    li = read_positions(spark, path) if row_ids else table(spark, sf_dir, "lineitem")
    rating = (F.lit(1) + F.pmod(F.col("l_linenumber") - 1, F.lit(5))).cast("double")
    helpful = F.pmod(F.floor("l_quantity").cast("long"), F.lit(10))
    verified = F.col("l_returnflag") == "R"
    return li.select(
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey"),
        F.col("l_partkey").alias("product_id"),
        rating.alias("rating"), helpful.alias("helpful_vote"),
        verified.alias("verified_purchase"),
        F.col("l_shipdate").alias("timestamp"), *(["row_id"] if row_ids else []),
    ).withColumn("final_sentiment",
                 heuristic_sentiment("rating", "verified_purchase", "helpful_vote"))


def review_text():
    """Review text of a document: a phrase by doc_id, then its text; some ids
    give the texts that the cleaning rules drop (links, file names, missing
    values, blanks) or decode (character references, markup)."""
    phrase = F.element_at(F.array(*map(F.lit, REVIEW_PHRASES)),
                          (F.pmod("doc_id", F.lit(len(REVIEW_PHRASES))) + 1).cast("int"))
    odd = F.element_at(F.array(*map(F.lit, ODD_TEXTS)),
                       (F.pmod(F.floor(F.col("doc_id") / ODD_STEP), F.lit(len(ODD_TEXTS))) + 1).cast("int"))
    return F.when(F.col("text").isNull(), F.lit(None)).when(F.pmod("doc_id", F.lit(ODD_STEP)) == 0, odd) \
        .otherwise(F.concat(phrase, F.lit(" "), F.col("text")))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw review rows (REVIEWS shape plus row_id) from `documents`."""
    docs = table(spark, sf_dir, "documents")
    nparts = table(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()
    pasin = F.pmod(F.col("doc_id") * DOC_TO_PRODUCT_STRIDE, nparts).cast("string")
    return docs.select(
        F.col("doc_id").alias("row_id"),
        (F.lit(1) + F.pmod("doc_id", F.lit(5))).cast("double").alias("rating"),
        F.col("source").alias("title"),
        review_text().alias("text"),
        pasin.alias("asin"),
        pasin.alias("parent_asin"),
        F.col("lang").alias("user_id"),
        (F.lit(TEXT_REVIEW_EPOCH_MS) + F.col("doc_id") * TEXT_REVIEW_STEP_MS).alias("timestamp"),
        (F.pmod("doc_id", F.lit(3)) != 0).alias("verified_purchase"),
        F.pmod("n_chars", F.lit(10)).alias("helpful_vote"),
    )


def raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product metadata rows (METADATA columns used downstream) from `part`."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_type").alias("main_category"),
        F.col("p_name").alias("title"),
        (F.col("p_size") / F.lit(10.0)).alias("average_rating"),
        F.col("p_size").cast("long").alias("rating_number"),
        F.col("p_retailprice").alias("price"),
        F.col("p_brand").alias("store"),
        F.col("p_partkey").cast("string").alias("parent_asin"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def live_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered review arrivals from `events` (T1 input in batch form)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("review_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("store"),
        F.col("user_id"),
        (F.lit(1) + F.pmod(F.col("event_id"), F.lit(5))).cast("double").alias("rating"),
        F.pmod(F.floor("value").cast("long"), F.lit(10)).alias("helpful_vote"),
        F.col("props"),
    )


def eval_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth for model evaluation: labels joined to documents.
    y = 1 (negative) if toxic, else 0 (positive) if quality, else 2."""
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    y = F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 0).otherwise(2)
    return lab.join(docs, "doc_id").select(
        "doc_id", F.col("source").alias("main_category"), F.col("lang").alias("store"),
        "n_chars", y.cast("int").alias("label"))


# Columns that make a lineitem-derived review unique, in id order, and those
# that part rows which tie in them.
REVIEW_KEY = ["l_orderkey", "l_linenumber", "product_id", "l_suppkey"]
REVIEW_TIES = ["timestamp", "helpful_vote", "final_sentiment"]


def _labeled(spark: SparkSession, sf_dir: str, r: DataFrame, *more: str) -> DataFrame:
    """Reviews of known products with encoded label, category and store."""
    from ..functions.labels import encode_label
    # category (p_type) and store (p_brand) straight from the product table
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"),
                                            F.col("p_type").alias("main_category"),
                                            F.col("p_brand").alias("store"))
    return r.join(p, "product_id").select(
        "row_id", "product_id", "rating", "helpful_vote", "timestamp", "final_sentiment",
        encode_label("final_sentiment").alias("label"), "main_category", "store", *more)


def labeled_facts(spark: SparkSession, sf_dir: str, row_ids: bool = True) -> DataFrame:
    """Numeric reviews with their position as row id, encoded label, category
    and store (input of the sampling / balancing operators).
    ``row_ids=False`` leaves the position out for consumers that only count."""
    r = review_facts(spark, sf_dir, row_ids)
    if not row_ids:
        r = r.withColumn("row_id", F.lit(None).cast("long"))
    return _labeled(spark, sf_dir, r)


def ranked_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`labeled_facts` with a review's rank by `REVIEW_KEY` (nulls last) among
    the reviews of known products as row id, however the files lie."""
    from ..operators.ordering import with_row_id
    keys = [c for c in REVIEW_KEY if c != "product_id"]
    d = _labeled(spark, sf_dir, review_facts(spark, sf_dir).withColumn("row_id", F.lit(None).cast("long")), *keys)
    order = [F.col(c).asc_nulls_last() for c in [*REVIEW_KEY, *REVIEW_TIES]]
    columns = [c for c in d.columns if c not in keys]
    return with_row_id(d.drop("row_id"), order).select(*columns)


# --- predictions of the evaluation queries --------------------------------------------
# Rows in the shape that E1 writes, by fixed rules: name -> (index m, skill).
# Score of class k: ((doc_id * (3 + 2m) + 7k + n_chars) mod 9) + 1, plus the
# skill where k is the label and doc_id mod (m + 2) is not 0.  Probabilities
# are the scores divided by their sum (exact rationals).
MODELS = {"model_a": (0, 6), "model_b": (1, 4), "model_c": (2, 2)}


def _score(m: int, skill: int, k: int, mod: str) -> str:
    return (f"CAST({mod.format(f'doc_id * {3 + 2 * m} + {7 * k} + n_chars', 9)} + 1 + CASE WHEN label = {k} "
            f"AND {mod.format('doc_id', m + 2)} <> 0 THEN {skill} ELSE 0 END AS DOUBLE)")


def predictions(spark: SparkSession, sf_dir: str, models=tuple(MODELS)) -> DataFrame:
    """`eval_labels` with the predictions of several models, a row each."""
    per_model = [F.struct(F.lit(n).alias("Model_Name"), F.array(*[F.expr(_score(*MODELS[n], k, "pmod({}, {})"))
                                                                  for k in range(3)]).alias("_s")) for n in models]
    x = eval_labels(spark, sf_dir)
    s = F.col("_s")
    return (x.select("*", F.inline(F.array(*per_model)))
             .withColumn("probs", F.transform(s, lambda v: v / (s[0] + s[1] + s[2])))
             .withColumn("prediction", argmax("probs")).select(*x.columns, "probs", "prediction", "Model_Name"))


def predictions_sql(name: str) -> list[str]:
    """The scores of a model's classes in DuckDB SQL."""
    return [_score(*MODELS[name], k, "(({}) % {})") for k in range(3)]
