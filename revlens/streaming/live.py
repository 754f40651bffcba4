"""Live review path as Structured Streaming.

The batch column functions are reused unchanged on streaming DataFrames.
State is kept only where the semantics need it: windowed counts (bounded by
the watermark) and replay de-duplication (bounded by the watermark); the
drift counter's events per key, changed window counts and the sums behind
live panels are run tables, which batches add to without rewriting them.  Every query writes to a
sink with a checkpoint in the shared checkpoint folder, so a restart or a
lost executor resumes exactly where the last committed batch ended.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import drift as DR
from ..operators import labeling as L
from ..operators.dashboard import SUM_KEYS, SUMS, review_sums
from ..operators.ordering import rank_within
from ..session import materialize, scratch_path
from .runs import RunTable


def stream_path(path: str) -> str:
    """A file stream source needs a directory or a glob: a single file is
    turned into a one-file glob."""
    if path.endswith("/") or os.path.isdir(path) or any(c in path for c in "*?["):
        return path
    return path[:-1] + f"[{path[-1]}]"


def review_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of review rows from files landing under ``path``."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.format(fmt).load(stream_path(path))


def label_stream(reviews: DataFrame, metadata: DataFrame, keep=None) -> DataFrame:
    """Merge (stream-static join), clean, filter and label live reviews
    with the batch operators.  The products meet the reviews in a shuffle: a
    broadcast would pass all of them through the driver for every batch."""
    return L.label_reviews(reviews, metadata.hint("merge"), keep=keep)


def label_late_metadata(reviews: DataFrame, metadata: DataFrame, review_time: str, metadata_time: str,
                        bound: str = "1 day", watermark: str = "1 day", keep=None) -> DataFrame:
    """T1/T2 with metadata that arrives after the reviews: a stream-stream
    join on the product.  A review is labeled once, by the product's
    metadata of at most ``bound`` after it (or the same time); a review
    whose metadata comes later than that is not labeled.

    Both sides keep state only for the bound and the watermark.  A product
    described several times within the bound still labels a review once:
    the first description to meet it counts, replays are dropped within the
    watermark.  ``row_id`` tells reviews apart."""
    product = "_product"
    described = metadata.withColumnRenamed("parent_asin", product).withWatermark(metadata_time, watermark)
    described = described.withColumnRenamed("title", "product_title")
    own = [c for c in described.columns if c not in reviews.columns]
    near = (F.col(metadata_time) >= F.col(review_time)) & \
        (F.col(metadata_time) <= F.col(review_time) + F.expr(f"INTERVAL {bound}"))
    merged = (reviews.withColumnRenamed("title", "review_title").withWatermark(review_time, watermark)
              .join(described.select(*own), (F.col("parent_asin") == F.col(product)) & near))
    merged = merged.drop(metadata_time).dropDuplicatesWithinWatermark(["row_id"])
    return L.label_merged(merged, keep)


def windowed_sentiment(stream: DataFrame, ts_col: str = "timestamp", label_col: str = "final_sentiment",
                       window: str = "1 day", slide: str | None = None, watermark: str = "1 day",
                       session_gap: str | None = None) -> DataFrame:
    """Review counts per label over event-time windows (tumbling,
    sliding with ``slide``, or session windows with ``session_gap``).
    Rows later than the watermark are dropped; window state is evicted once
    the watermark passes the window end."""
    s = stream.withWatermark(ts_col, watermark)
    if session_gap:
        w = F.session_window(F.col(ts_col), session_gap)
    elif slide:
        w = F.window(F.col(ts_col), window, slide)
    else:
        w = F.window(F.col(ts_col), window)
    return (s.groupBy(w.alias("w"), F.col(label_col))
             .agg(F.count(F.lit(1)).alias("n"))
             .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                     label_col, "n"))


def dedup_replays(stream: DataFrame, id_col: str = "review_id", ts_col: str = "timestamp",
                  watermark: str = "1 day") -> DataFrame:
    """Drop re-delivered rows with the same id seen within the
    watermark, so replays never double count."""
    return stream.withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark([id_col])


def drift_counter_batches(sink: str, key: str = "key", reset_at: int = 10):
    """T4: the X6 counter over a stream, as a foreachBatch function.

    Each micro-batch ranks its events per key with the distributed rank (no
    task holds all events of a key) in event-time order, ties by event_id,
    and continues from the events that earlier batches counted; across
    batches the order is arrival order.  The state is a compacted table of
    events seen per key.  Rows are written before the state is committed: a
    batch that runs again replaces its own folder, or is done already."""
    def fn(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        state = RunTable(spark, f"{sink}/seen", ["key"], ["n"])
        _, entry = state.log.latest()
        if entry is not None and entry["batch"] >= batch_id:
            return
        ev = batch.select(F.col(key).cast("long").alias("key"), "event_id", "ts")
        ranked = rank_within(ev, ["ts", "event_id"], by=["key"], name="_k")
        if entry is None:
            ranked = ranked.withColumn("_seen", F.lit(0).cast("long"))
        else:
            seen = state.read().select(F.col("key").alias("_of"), F.col("n").alias("_seen"))
            ranked = ranked.join(seen, ranked["key"].eqNullSafe(seen["_of"]), "left").drop("_of")
        k = F.col("_k") + F.coalesce("_seen", F.lit(0))
        count = F.pmod(k - 1, F.lit(reset_at))
        ranked.select("key", "event_id", "ts", count.cast("int").alias("drift_counter"),
                      ((k > 1) & (count == 0)).alias("triggered")) \
            .write.mode("overwrite").parquet(f"{sink}/rows/batch={batch_id}")
        state.add(ev.groupBy("key").agg(F.count(F.lit(1)).alias("n")), batch_id)
    return fn


def panel_batches(sink: str, op: str | None = None):
    """A1-A11 kept up by a stream of reviews: a foreachBatch function that
    adds the batch's partial sums to the run table in ``sink``.  ``op`` names
    a column of 1 (review added) and -1 (taken back, with the values it was
    added with)."""
    def fn(batch: DataFrame, batch_id: int):
        panel_table(batch.sparkSession, sink).add(review_sums(batch, op), batch_id)
    return fn


def panel_table(spark: SparkSession, sink: str) -> RunTable:
    """The sums behind the panels; ``read()`` goes where panels take reviews."""
    return RunTable(spark, sink, SUM_KEYS, SUMS)


def drift_check_batch(reference: DataFrame, vocab: DataFrame, text_col: str = "cleaned_text",
                      id_col: str = "review_id", latest: int = 5, sink: str | None = None):
    """T5: a foreachBatch function - after each appended micro-batch,
    compare its latest ``latest`` reviews with the reference window (X5) and
    write the report rows to the batch's own folder in ``sink`` (a batch run
    again replaces them).  ``reference`` and ``vocab`` should be stored
    tables: they are read once per batch."""
    def fn(batch: DataFrame, batch_id: int):
        cur = materialize(batch.select(id_col, text_col).orderBy(F.desc(id_col)).limit(latest), "latest")
        rep = DR.descriptor_drift(reference, cur, text_col, vocab, id_col)
        if sink:
            rep.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
    return fn


def append_live_reviews(sink: str):
    """A foreachBatch function that appends scored live reviews to the
    fact table: the product's id, the time of the append, no helpful votes
    yet.  A batch run again replaces its own folder."""
    def fn(batch: DataFrame, batch_id: int):
        rows = batch.select("review_id", "product_id", "cleaned_text", "rating",
                            F.lit(0).cast("long").alias("helpful_vote"), F.current_timestamp().alias("timestamp"),
                            "final_sentiment")
        rows.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    return fn


def run_available_now(stream: DataFrame, name: str, mode: str = "append",
                      sink_format: str = "parquet", foreach_batch=None,
                      spark: SparkSession | None = None, arrivals=None) -> str:
    """Run a streaming query over everything available now into a sink in
    the checkpoint folder and wait for it; returns the sink path.  With
    ``arrivals`` (functions that each deliver some files) the query goes on
    from its checkpoint after each of them."""
    spark = spark or stream.sparkSession
    base = scratch_path(spark, f"stream-{name}")
    for deliver in arrivals or [lambda: None]:
        deliver()
        w = stream.writeStream.option("checkpointLocation", f"{base}/_checkpoint").outputMode(mode)
        if foreach_batch is not None:
            w = w.foreachBatch(foreach_batch)
        else:
            w = w.format(sink_format).option("path", f"{base}/data")
        w.trigger(availableNow=True).start().awaitTermination()
    return f"{base}/data"
