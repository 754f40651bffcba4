"""Registered labeling-pipeline and quality queries (J1, C1, C3-C5, L1-L6, Q1-Q6, P*)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import compute_once
from ..functions import labels as LB
from ..functions import lexicon as LX
from ..functions import text as TX
from ..operators import clean as C
from ..operators import labeling as L
from ..operators import quality as Q
from ..session import scratch_path
from ..sources import schemas as S
from ..sources import testdata as td
from .catalog import register
from .sqltext import (is_file_sql, is_missing_sql, is_url_sql, lexicon_a_sql, lexicon_b_sql,
                      lexicon_scores_cte, majority_sql, strip_html_sql)
from .sqlviews import heuristic_sql, with_views

_MERGED_SQL = """
  SELECT r.row_id, r.text, r.rating, m.title AS product_title, m.store, m.price, r.helpful_vote,
         m.main_category, r.parent_asin, r.timestamp, r.verified_purchase
  FROM raw_reviews_v r JOIN raw_metadata_v m ON r.parent_asin = m.parent_asin
  WHERE r.text IS NOT NULL AND r.rating IS NOT NULL AND NOT isnan(r.rating)"""


def _merged(spark, sf):
    return L.merge_reviews(td.raw_reviews(spark, sf), td.raw_metadata(spark, sf))


@register("j1_merge_reviews", with_views("SELECT * FROM merged", "raw_reviews_v", "raw_metadata_v",
                                         extra={"merged": _MERGED_SQL}))
def j1(spark, sf):
    """Reviews JOIN metadata on parent_asin, renamed, null-dropped, wide columns."""
    return _merged(spark, sf)


def _hot_reviews(spark, sf):
    """The raw reviews with a third of them on one product."""
    r = td.raw_reviews(spark, sf)
    return r.withColumn("parent_asin", F.when(F.pmod("row_id", F.lit(3)) == 0, F.lit("1")).otherwise(F.col("parent_asin")))


@register("j1_merge_hot_product", with_views("""SELECT r.row_id, r.rating, m.title AS product_title, m.main_category, r.parent_asin
FROM (SELECT * REPLACE (CASE WHEN row_id % 3 = 0 THEN '1' ELSE parent_asin END AS parent_asin) FROM raw_reviews_v) r
JOIN raw_metadata_v m USING (parent_asin) WHERE r.text IS NOT NULL AND r.rating IS NOT NULL AND NOT isnan(r.rating)""",
                                             "raw_reviews_v", "raw_metadata_v"))
def j1_hot(spark, sf):
    """J1 with a third of all reviews on one product, which a sketch of the
    keys finds and the join spreads."""
    out = L.merge_reviews(_hot_reviews(spark, sf), td.raw_metadata(spark, sf), hot_one_in=1000)
    return out.select("row_id", "rating", "product_title", "main_category", "parent_asin")


@register("c1_strip_html", f"SELECT page_id, {strip_html_sql('html')} AS cleaned_text FROM pages")
def c1(spark, sf):
    """HTML pages to lower-cased text."""
    return C.strip_html_tags(td.pages(spark, sf), "html", "cleaned_text").select("page_id", "cleaned_text")


@register("p10_drop_blank", with_views(r"""SELECT row_id FROM raw_reviews_v
WHERE text IS NOT NULL AND regexp_matches(text,
  '[^\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]')""",
                                      "raw_reviews_v"))
def p10(spark, sf):
    """P10: reviews whose text is not blank after a Python-style strip."""
    return C.drop_blank(td.raw_reviews(spark, sf), "text").select("row_id")


_CLEANED = {"merged": _MERGED_SQL,
            "cleaned": f"SELECT * EXCLUDE (text), {strip_html_sql('text')} AS cleaned_text FROM merged"}


def _cleaned(spark, sf):
    return C.strip_html_tags(_merged(spark, sf)).drop("text").select("row_id", "cleaned_text")


@register("c3_drop_urls", with_views(
    f"SELECT row_id, cleaned_text FROM cleaned WHERE NOT {is_url_sql('cleaned_text')}",
    "raw_reviews_v", "raw_metadata_v", extra=_CLEANED))
def c3(spark, sf):
    """Drop texts starting with a URL scheme."""
    return C.drop_urls(_cleaned(spark, sf))


@register("c4_drop_file_names", with_views(
    f"SELECT row_id, cleaned_text FROM cleaned WHERE NOT {is_file_sql('cleaned_text')}",
    "raw_reviews_v", "raw_metadata_v", extra=_CLEANED))
def c4(spark, sf):
    """C4: drop texts that look like a file name."""
    return C.drop_file_names(_cleaned(spark, sf))


@register("c5_drop_missing_text", with_views(
    f"SELECT row_id, cleaned_text FROM cleaned WHERE NOT {is_missing_sql('cleaned_text')}",
    "raw_reviews_v", "raw_metadata_v", extra=_CLEANED))
def c5(spark, sf):
    """Drop null / missing-token texts."""
    return C.drop_missing_text(_cleaned(spark, sf))


@register("l1_heuristic_sentiment", with_views(
    f"SELECT row_id, {heuristic_sql('rating', 'verified_purchase', 'helpful_vote')} AS heuristic_sentiment "
    "FROM raw_reviews_v", "raw_reviews_v"))
def l1(spark, sf):
    """L1: rating rule on every raw review."""
    r = td.raw_reviews(spark, sf)
    return r.select("row_id", LB.heuristic_sentiment("rating", "verified_purchase", "helpful_vote")
                    .alias("heuristic_sentiment"))


def _lex_sql(body):
    return with_views(body, "raw_reviews_v", extra=lexicon_scores_cte("raw_reviews_v", "row_id", "text"))


def _tokens(spark, sf):
    r = td.raw_reviews(spark, sf).select("row_id", "text")
    return compute_once(r, _tokens=TX.word_tokens("text"))


@register("l2_lexicon_a_sentiment", _lex_sql(
    f"""SELECT d.row_id, CASE WHEN d.text IS NOT NULL THEN coalesce(s.grades, 0) END AS grades,
  {lexicon_a_sql('coalesce(s.grades, 0)', 'd.text')} AS lexicon_a_sentiment
FROM raw_reviews_v d LEFT JOIN scores s ON d.row_id = s.id"""))
def l2(spark, sf):
    """L2: compound lexicon score label of every review text."""
    d = compute_once(_tokens(spark, sf), _a=LX.grade_sum("_tokens"))
    return d.select("row_id", F.col("_a").cast("long").alias("grades"),
                    LX.sentiment_a(F.col("_a")).alias("lexicon_a_sentiment"))


@register("l3_lexicon_b_sentiment", _lex_sql(
    f"""SELECT d.row_id, coalesce(s.eighths, 0)::BIGINT AS eighths, coalesce(s.hits, 0)::BIGINT AS hits,
  {lexicon_b_sql('coalesce(s.eighths, 0)', 'd.text')} AS lexicon_b_sentiment
FROM raw_reviews_v d LEFT JOIN scores s ON d.row_id = s.id"""))
def l3(spark, sf):
    """L3: mean-polarity label of every review text (boosters, negations)."""
    d = compute_once(_tokens(spark, sf), _b=LX.polarity_sum("_tokens"))
    return d.select("row_id", F.coalesce(F.col("_b.eighths"), F.lit(0)).cast("long").alias("eighths"),
                    F.coalesce(F.col("_b.hits"), F.lit(0)).cast("long").alias("hits"),
                    LX.sentiment_b(F.col("_b")).alias("lexicon_b_sentiment"))


_L6_BODY = f"""SELECT f.*, {heuristic_sql('f.rating', 'f.verified_purchase', 'f.helpful_vote')} AS heuristic_sentiment,
  {lexicon_a_sql('coalesce(s.grades, 0)', 'f.cleaned_text')} AS lexicon_a_sentiment,
  {lexicon_b_sql('coalesce(s.eighths, 0)', 'f.cleaned_text')} AS lexicon_b_sentiment
FROM filtered f LEFT JOIN scores s ON f.row_id = s.id"""

_L6_CTES = {**_CLEANED,
            "filtered": f"""SELECT * FROM cleaned
  WHERE NOT {is_url_sql('cleaned_text')} AND NOT {is_file_sql('cleaned_text')}
    AND NOT {is_missing_sql('cleaned_text')}""",
            **lexicon_scores_cte("filtered", "row_id", "cleaned_text"),
            "labeled": _L6_BODY}


@register("l4_majority_vote", with_views(
    f"""SELECT row_id, {majority_sql('heuristic_sentiment', 'lexicon_a_sentiment', 'lexicon_b_sentiment')}
  AS final_sentiment FROM labeled""", "raw_reviews_v", "raw_metadata_v", extra=_L6_CTES))
def l4(spark, sf):
    """L4: majority vote of the three labels."""
    return _l6(spark, sf).select("row_id", "final_sentiment")


def _l6(spark, sf):
    return L.label_reviews(td.raw_reviews(spark, sf), td.raw_metadata(spark, sf))


def _l6_spread(spark, sf):
    """The same rows for jobs that store them: a table of few row groups is
    read by as few tasks, so the texts are dealt over all before they are
    labeled, and what is stored has as many files."""
    return L.label_reviews(td.raw_reviews(spark, sf).repartition("row_id"), td.raw_metadata(spark, sf))


@register("l6_label_reviews", with_views(
    f"""SELECT *, {majority_sql('heuristic_sentiment', 'lexicon_a_sentiment', 'lexicon_b_sentiment')}
  AS final_sentiment FROM labeled""", "raw_reviews_v", "raw_metadata_v", extra=_L6_CTES))
def l6(spark, sf):
    """End-to-end labeled review table (merge, clean, filter, 3 labels, vote)."""
    return _l6(spark, sf)


_Q1_TYPES = [("rating", "double", "DOUBLE"), ("title", "string", "VARCHAR"), ("text", "string", "VARCHAR"),
             ("asin", "string", "VARCHAR"), ("parent_asin", "string", "VARCHAR"), ("user_id", "bigint", "BIGINT"),
             ("timestamp", "bigint", "BIGINT"), ("verified_purchase", "boolean", "BOOLEAN"),
             ("helpful_vote", "bigint", "BIGINT")]


@register("q1_schema_report", with_views(" UNION ALL ".join(
    f"""SELECT '{c}' AS column, '{t}' AS expected, count(*) AS n, count(*) - count({c}) AS missing,
  count({c}) - count(TRY_CAST({c} AS {d})) AS bad FROM raw_reviews_v""" for c, t, d in _Q1_TYPES), "raw_reviews_v"))
def q1(spark, sf):
    """Q1: values of the raw reviews against declared types; the user id is
    declared a number here, which its values are not."""
    wrong = T.StructType([T.StructField(f.name, T.LongType() if f.name == "user_id" else f.dataType)
                          for f in S.REVIEWS.fields])
    return Q.value_report(td.raw_reviews(spark, sf), wrong)


@register("q1_observed_write", with_views(" UNION ALL ".join(
    f"""SELECT '{c}' AS column, '{t}' AS expected, count(*) AS n, count(*) - count({c}) AS missing,
  count({c}) - count(TRY_CAST({c} AS {d})) AS bad FROM raw_reviews_v""" for c, t, d in _Q1_TYPES), "raw_reviews_v"))
def q1_observed(spark, sf):
    """Q1 counted while the reviews are written, without a pass of its own."""
    wrong = T.StructType([T.StructField(f.name, T.LongType() if f.name == "user_id" else f.dataType)
                          for f in S.REVIEWS.fields])
    return Q.observed_write(td.raw_reviews(spark, sf), scratch_path(spark, "observed"), declared=wrong)[0]


@register("q6_observed_write", with_views(
    """SELECT CAST(CASE final_sentiment WHEN 'positive' THEN 0 WHEN 'negative' THEN 1 WHEN 'neutral' THEN 2 END
       AS INTEGER) AS label, COUNT(*) AS count FROM reviews_v GROUP BY 1""", "reviews_v"))
def q6_observed(spark, sf):
    """Q4 + Q6 counted while the labeled reviews are written."""
    r = td.review_facts(spark, sf).withColumn("label", LB.encode_label("final_sentiment"))
    return Q.observed_write(r, scratch_path(spark, "observed"), label="label")[1]


@register("q2_schema_differences", with_views("""SELECT t AS "table", c AS "column", expected, n, missing, bad FROM (
  SELECT 'reviews' AS t, 'user_id' AS c, 'bigint' AS expected, count(*) AS n, count(*) - count(user_id) AS missing,
    count(user_id) - count(TRY_CAST(user_id AS BIGINT)) AS bad FROM raw_reviews_v
  UNION ALL SELECT 'metadata', 'store', 'double', count(*), count(*) - count(store),
    count(store) - count(TRY_CAST(store AS DOUBLE)) FROM raw_metadata_v) x WHERE bad > 0""",
                                              "raw_reviews_v", "raw_metadata_v"))
def q2(spark, sf):
    """Q2: findings over several tables: the columns of the raw reviews and
    metadata with values that are not of the declared type (the user id and
    the store are declared numbers here)."""
    def declared(schema, **kinds):
        return T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in schema.fields])
    return Q.value_findings({"reviews": (td.raw_reviews(spark, sf), declared(S.REVIEWS, user_id=T.LongType())),
                             "metadata": (td.raw_metadata(spark, sf), declared(S.METADATA, store=T.DoubleType()))})


@register("q4_label_domain", with_views(
    """SELECT array_to_string(list_sort(list(DISTINCT CAST(label AS VARCHAR))), ',') AS labels, true AS ok
FROM (SELECT CASE final_sentiment WHEN 'positive' THEN 0 WHEN 'negative' THEN 1 WHEN 'neutral' THEN 2 END AS label
      FROM reviews_v) t""", "reviews_v"))
def q4(spark, sf):
    """Q4: the encoded labels are exactly {0, 1, 2}."""
    r = td.review_facts(spark, sf).withColumn("label", LB.encode_label("final_sentiment", strict=True))
    return Q.label_domain(r, "label")


@register("q5_duplicate_rows", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE (l_orderkey, l_linenumber) IN (
  SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)""")
def q5(spark, sf):
    """Q5: all members of duplicate (l_orderkey, l_linenumber) groups."""
    li = td.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return Q.duplicate_rows(li, ["l_orderkey", "l_linenumber"])


@register("q6_class_distribution", with_views(
    """SELECT CAST(CASE final_sentiment WHEN 'positive' THEN 0 WHEN 'negative' THEN 1 WHEN 'neutral' THEN 2 END
       AS INTEGER) AS label, COUNT(*) AS count FROM reviews_v GROUP BY 1""", "reviews_v"))
def q6(spark, sf):
    """Q6: class distribution of the encoded labels."""
    r = td.review_facts(spark, sf).withColumn("label", LB.encode_label("final_sentiment"))
    return Q.class_distribution(r, "label")


@register("p_scalar_functions", with_views(
    """SELECT row_id,
  CAST(CASE lower(title) WHEN 'src1' THEN 0 ELSE NULL END AS INTEGER) AS p5_label_or_null,
  CASE CAST(row_id % 4 AS INTEGER) WHEN 0 THEN 'Positive' WHEN 1 THEN 'Negative' WHEN 2 THEN 'Neutral' END AS p6_name,
  regexp_replace(user_id || ' ' || title || '/x.y', '[^a-zA-Z0-9_:/-]', '_', 'g') AS p11_safe,
  date_trunc('year', make_timestamp(timestamp * 1000)) AS p13_year,
  CAST(make_timestamp(timestamp * 1000) AS DATE) AS p14_date,
  date_trunc('second', make_timestamp(timestamp * 1000)) AS p15_ts,
  title || '_' || user_id AS p20_key
FROM raw_reviews_v""", "raw_reviews_v"))
def p_scalar(spark, sf):
    """P5, P6, P9, P11, P13, P14, P15, P20 scalar functions on every raw review."""
    r = td.raw_reviews(spark, sf)
    from ..operators.star import epoch_ms_to_ts
    ts = epoch_ms_to_ts("timestamp")
    return r.select(
        "row_id",
        F.when(F.lower("title") == "src1", F.lit("positive")).otherwise(F.lit("other")).alias("_lbl"),
        F.pmod("row_id", F.lit(4)).cast("int").alias("_k"), "user_id", "title", ts.alias("p15_ts"),
    ).select(
        "row_id",
        LB.encode_label("_lbl").alias("p5_label_or_null"),
        LB.decode_label("_k").alias("p6_name"),
        F.concat(F.col("user_id"), F.lit(" "), F.col("title"), F.lit("/x.y")).alias("_raw"),
        F.date_trunc("year", "p15_ts").cast("timestamp_ntz").alias("p13_year"),
        F.to_date("p15_ts").alias("p14_date"),
        "p15_ts",
        F.concat_ws("_", "title", "user_id").alias("p20_key"),
    ).select("row_id", "p5_label_or_null", "p6_name", TX.metric_safe("_raw").alias("p11_safe"),
             "p13_year", "p14_date", "p15_ts", "p20_key")
