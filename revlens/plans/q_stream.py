"""Registered streaming queries (T1-T6): each runs a Structured Streaming
query over the whole input with an availableNow trigger and returns what
its sink holds, so it can be checked against the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import heuristic_sentiment
from ..operators import dashboard as D
from ..operators import drift as DR
from ..session import materialize, scratch_path
from ..sources import testdata as td
from ..streaming import live as LV
from ..streaming.runs import RunTable
from .catalog import register
from .q_drift import _X6, _desc_ctes, _freq_sql, _ks_sql, _rounded
from .q_pipeline import _L6_CTES
from .q_star import _SRC, _STAR_CTES, _stored
from .q_star import _sql as _star_sql
from .sqltext import majority_sql
from .sqlviews import heuristic_sql, with_views


#: Steps (and so micro-batches) that a table arrives in, and the least files of a
#: step: one for each task that can run at once, as a file of one row group is
#: read by one task.
ARRIVALS = 4
FILES = 4


def _arriving(spark, df, order: str, name: str):
    """(stream, arrivals): a stream over ``df`` and the functions that
    deliver it, a range of ``order`` at a time as `FILES` files or more."""
    files = max(FILES, spark.sparkContext.defaultParallelism)
    path = scratch_path(spark, f"arrive-{name}")
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    lo, hi = (0, 0) if lo is None else (lo, hi)
    part = F.floor((F.col(order) - lo) * ARRIVALS / (hi - lo + 1))

    def step(k):
        return lambda: df.filter(part == k).repartition(files).write.mode("append").parquet(path)

    df.limit(0).write.parquet(path)  # the folder is there before its rows
    return LV.review_stream(spark, path, df.schema), [step(k) for k in range(ARRIVALS)]


def _events_stream(spark, sf):
    return _arriving(spark, td.table(spark, sf, "events"), "event_id", "events")


def _live(ev):
    """events -> live review rows (same rule as testdata.live_reviews)."""
    return ev.select(
        F.col("event_id").alias("review_id"), F.col("ts").cast("timestamp").alias("timestamp"),
        (F.lit(1) + F.pmod(F.col("event_id"), F.lit(5))).cast("double").alias("rating"),
        F.pmod(F.floor("value").cast("long"), F.lit(10)).alias("helpful_vote"),
    ).withColumn("final_sentiment", heuristic_sentiment("rating", None, "helpful_vote"))


_LIVE_SQL = f"""SELECT event_id AS review_id, ts AS timestamp,
  {heuristic_sql('CAST(1 + event_id % 5 AS DOUBLE)', 'NULL', 'CAST(floor(value) AS BIGINT) % 10')} AS final_sentiment
FROM events"""


@register("t3_stream_windowed_counts", with_views(
    """SELECT time_bucket(INTERVAL 1 DAY, timestamp) AS window_start,
  time_bucket(INTERVAL 1 DAY, timestamp) + INTERVAL 1 DAY AS window_end, final_sentiment, COUNT(*) AS n
FROM live GROUP BY 1, 2, 3""", extra={"live": _LIVE_SQL}))
def t3(spark, sf):
    """T1 + T3: daily label counts of the live review stream (watermark 1 day)."""
    events, arrivals = _events_stream(spark, sf)
    agg = LV.windowed_sentiment(_live(events), "timestamp", "final_sentiment", "1 day", watermark="1 day")
    table = RunTable(spark, scratch_path(spark, "t3-windows"), ["window_start", "window_end", "final_sentiment"])
    LV.run_available_now(agg, "t3", mode="update", foreach_batch=table.add, arrivals=arrivals)
    out = table.read()
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "final_sentiment", "n")


@register("t6_stream_dedup_replays", with_views("SELECT DISTINCT review_id, timestamp FROM live",
                                                extra={"live": _LIVE_SQL}))
def t6(spark, sf):
    """A stream delivered twice (replay) is counted once."""
    (first, arrivals), (again, replays) = _events_stream(spark, sf), _events_stream(spark, sf)
    both = _live(first).unionByName(_live(again)).select("review_id", "timestamp")
    out = LV.dedup_replays(both, "review_id", "timestamp", "1 day")
    path = LV.run_available_now(out, "t6", arrivals=[lambda a=a, b=b: (a(), b()) for a, b in zip(arrivals, replays)])
    return spark.read.parquet(path).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@register("t4_stream_drift_counter", _X6.replace("SELECT user_id,", "SELECT user_id AS key,", 1))
def t4(spark, sf):
    """T4: the drift counter over several micro-batches."""
    events, arrivals = _events_stream(spark, sf)
    ev = events.filter(F.col("event_type") == "error").select("user_id", "event_id", "ts")
    sink = scratch_path(spark, "t4-counters")
    LV.run_available_now(ev, "t4", foreach_batch=LV.drift_counter_batches(sink, "user_id"), arrivals=arrivals)
    return spark.read.parquet(f"{sink}/rows").drop("batch")


@register("t2_stream_label_append", with_views(
    f"""SELECT *, {majority_sql('heuristic_sentiment', 'lexicon_a_sentiment', 'lexicon_b_sentiment')}
  AS final_sentiment FROM labeled""", "raw_reviews_v", "raw_metadata_v", extra=_L6_CTES))
def t2(spark, sf):
    """T1 + T2: raw reviews arriving as a stream, merged with static
    metadata, cleaned, labeled and appended to a table."""
    live, arrivals = _labeled_stream(spark, sf)
    out = LV.run_available_now(live, "t2", arrivals=arrivals)
    return spark.read.parquet(out)


def _labeled_stream(spark, sf):
    raw = td.raw_reviews(spark, sf)
    stream, arrivals = _arriving(spark, raw, "row_id", "reviews")
    return LV.label_stream(stream, td.raw_metadata(spark, sf)), arrivals


# Product k is described k hours into 2020, as a stream of its own behind the
# reviews.
@register("t8_late_metadata", with_views(
    f"""SELECT *, {majority_sql('heuristic_sentiment', 'lexicon_a_sentiment', 'lexicon_b_sentiment')}
  AS final_sentiment FROM labeled WHERE parent_asin::BIGINT * 3600000 + 1577836800000 BETWEEN timestamp AND timestamp + 2592000000""",
    "raw_reviews_v", "raw_metadata_v", extra=_L6_CTES))
def t8(spark, sf):
    """T1 + T2: reviews and product metadata as two streams; metadata that
    comes up to 30 days after a review labels it, once."""
    raw = td.raw_reviews(spark, sf).withColumn("review_time", F.timestamp_millis("timestamp"))
    hour = F.col("parent_asin").cast("bigint") * 3_600_000 + F.lit(td.TEXT_REVIEW_EPOCH_MS)
    meta = td.raw_metadata(spark, sf).withColumn("_order", F.col("parent_asin").cast("bigint")) \
        .withColumn("metadata_time", F.timestamp_millis(hour))
    reviews, arrivals = _arriving(spark, raw, "row_id", "reviews")
    described, later = _arriving(spark, meta, "_order", "metadata")
    out = LV.label_late_metadata(reviews, described.drop("_order"), "review_time", "metadata_time", "30 days",
                                 watermark="2 days")
    return spark.read.parquet(LV.run_available_now(out, "t8", arrivals=[*arrivals, *later]))


@register("d7_append_live_reviews", _star_sql("""SELECT l.row_id AS review_id, p.product_id, l.cleaned_text, l.rating,
  CAST(0 AS BIGINT) AS helpful_vote, true AS appended_now, l.final_sentiment
FROM l6 l JOIN prods p ON p.product_title = l.product_title
JOIN cats c ON p.category_id = c.category_id AND c.category_name = l.main_category"""))
def d7(spark, sf):
    """Scored live reviews appended to the fact table, micro-batch by
    micro-batch, with the product id from the stored star, the time of the
    append and no helpful votes."""
    cats, prods, _ = _stored(spark, sf)
    shelf = prods.join(cats, "category_id").select("product_id", "product_title",
                                                   F.col("category_name").alias("main_category"))
    shelf = shelf.hint("merge")  # as `label_stream`: not collected anew for every batch
    labeled, arrivals = _labeled_stream(spark, sf)
    live = labeled.join(shelf, ["product_title", "main_category"]).withColumnRenamed("row_id", "review_id")
    sink = scratch_path(spark, "d7-fact")
    LV.run_available_now(live, "d7", foreach_batch=LV.append_live_reviews(sink), arrivals=arrivals)
    age = F.abs(F.current_timestamp().cast("double") - F.col("timestamp").cast("double"))
    return spark.read.parquet(sink).select("review_id", "product_id", "cleaned_text", "rating", "helpful_vote",
                                           (age < 86400).alias("appended_now"), "final_sentiment")


# batch b holds the ids in the b-th quarter of their range
_T5_CTES = {
    **_STAR_CTES,
    "refw": "SELECT * FROM fact WHERE review_id BETWEEN 1 AND 500",
    "vocab": _freq_sql("refw", "cleaned_text"),
    "arrived": """SELECT row_id AS review_id, cleaned_text,
    floor((row_id - lo) * 4 / (hi - lo + 1))::BIGINT AS batch_id
  FROM l6, (SELECT min(row_id) AS lo, max(row_id) AS hi FROM raw_reviews_v) r""",
    "curw": "SELECT * FROM arrived QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY review_id DESC) <= 5",
    **_desc_ctes("refw", "reference"), **_desc_ctes("curw", "current"),
    "current_b2": "SELECT d.*, c.batch_id FROM current_d d JOIN curw c USING (review_id)",
    "vals": """SELECT 'reference' AS sample, b || ':' || descriptor AS k, value
    FROM reference_l, (SELECT DISTINCT batch_id AS b FROM curw) x
  UNION ALL SELECT 'current', batch_id || ':' || descriptor, value FROM (UNPIVOT current_b2
    ON text_length, non_letter_share, oov_share INTO NAME descriptor VALUE value) u""",
    **_ks_sql("vals", "k"),
    "each": """SELECT split_part(k, ':', 1)::BIGINT AS batch_id, split_part(k, ':', 2) AS descriptor, n_ref, n_cur,
    ks_stat, p_value, coalesce(p_value < 0.05, false) AS drifted FROM ks""",
}


@register("t5_stream_drift_check", with_views("""SELECT * FROM each
UNION ALL SELECT batch_id, 'dataset', min(n_ref), min(n_cur), NULL, min(p_value), bool_or(drifted)
FROM each GROUP BY batch_id""", *_SRC, extra=_T5_CTES))
def t5(spark, sf):
    """T5 + X5 + X7: after each micro-batch of labeled live reviews, the
    latest 5 reviews are checked for descriptor drift against the first 500
    (foreachBatch); the report rows of every batch are returned."""
    fact = _stored(spark, sf)[2].select("review_id", "cleaned_text")
    reference = materialize(fact.filter(F.col("review_id").between(1, 500)))
    vocab = materialize(DR.word_frequencies(reference, "cleaned_text"))
    labeled, arrivals = _labeled_stream(spark, sf)
    live = labeled.select(F.col("row_id").alias("review_id"), "cleaned_text")
    sink = scratch_path(spark, "t5-reports")
    LV.run_available_now(live, "t5", foreach_batch=LV.drift_check_batch(reference, vocab, sink=sink), arrivals=arrivals)
    return _rounded(spark.read.parquet(sink).withColumn("batch_id", F.col("batch_id").cast("long")))


# --- panels kept up by a stream (A1-A11 over D7 / T3) ------------------------

def _live_sums(spark, sf):
    """Sums behind the panels after all arrivals: reviews arrive by order
    key, and those of every 7th order are taken back a quarter of the keys
    later."""
    rows = td.review_facts(spark, sf).select("l_orderkey", "product_id", "final_sentiment", "timestamp", "rating",
                                             "helpful_vote")
    lo, hi = rows.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    width = F.lit(((hi or 0) - (lo or 0)) // ARRIVALS + 1)
    back = rows.filter(F.pmod("l_orderkey", F.lit(7)) == 0)
    changes = (rows.withColumn("op", F.lit(1)).withColumn("at", F.col("l_orderkey"))
               .unionByName(back.withColumn("op", F.lit(-1)).withColumn("at", F.col("l_orderkey") + width)))
    stream, arrivals = _arriving(spark, changes, "at", "review-changes")
    sink = scratch_path(spark, "live-panels")
    LV.run_available_now(stream, "panels", foreach_batch=LV.panel_batches(sink, "op"), arrivals=arrivals)
    return LV.panel_table(spark, sink).read(), td.products(spark, sf), td.categories(spark, sf)


def _live_panel(sql: str):
    """The panel's SQL over the reviews that were not taken back."""
    return with_views(sql, "reviews_v", "products_v", "categories_v", extra={
        "held": "SELECT * FROM reviews_v WHERE l_orderkey % 7 <> 0",
        "shelf": "SELECT product_id, product_title, price, category_name FROM products_v JOIN categories_v USING (category_id)"})


@register("a5_live_yearly_sentiment", _live_panel("""SELECT category_name, date_trunc('year', timestamp)::TIMESTAMP AS review_year,
  count(*) FILTER (final_sentiment = 'positive') AS positive_reviews,
  count(*) FILTER (final_sentiment = 'negative') AS negative_reviews,
  count(*) FILTER (final_sentiment = 'neutral') AS neutral_reviews
FROM held JOIN shelf USING (product_id) GROUP BY ALL"""))
def a5_live(spark, sf):
    """A5 from sums that a stream of added and retracted reviews keeps up."""
    return D.yearly_sentiment(*_live_sums(spark, sf))


@register("a6_live_helpful_votes", _live_panel("""SELECT * FROM (
  SELECT category_name, product_title,
    coalesce(sum(helpful_vote) FILTER (final_sentiment = 'positive'), 0)::BIGINT AS positive_helpful_votes,
    coalesce(sum(helpful_vote) FILTER (final_sentiment = 'negative'), 0)::BIGINT AS negative_helpful_votes,
    row_number() OVER (PARTITION BY category_name ORDER BY positive_helpful_votes DESC, product_title) AS rank
  FROM held JOIN shelf USING (product_id) GROUP BY category_name, product_title) t WHERE rank <= 10"""))
def a6_live(spark, sf):
    """A6 from sums that a stream of added and retracted reviews keeps up."""
    return D.helpful_votes_top(*_live_sums(spark, sf))


@register("a7_live_average_rating", _live_panel("""SELECT category_name, product_title,
  ((2 * sum((rating * 10000)::BIGINT) + 100 * count(rating)) // (200 * count(rating)))::DOUBLE / 100 AS average_rating
FROM held JOIN shelf USING (product_id) GROUP BY category_name, product_title"""))
def a7_live(spark, sf):
    """A7 from sums that a stream of added and retracted reviews keeps up."""
    return D.top_rated_products(*_live_sums(spark, sf))
