"""Streaming behaviour that batch oracles cannot show: late rows, restarts."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators import dashboard as D
from revlens.sources import testdata as td
from revlens.sources.commitlog import CommitLog
from revlens.streaming import live as LV
from revlens.streaming.runs import RunTable

KEYS = ["window_start", "window_end", "final_sentiment"]
SCH = "review_id long, timestamp timestamp, final_sentiment string"


def _run(spark, stream, ck, sink):
    q = (stream.writeStream.option("checkpointLocation", ck).outputMode("update")
         .foreachBatch(RunTable(spark, sink, KEYS).add).trigger(availableNow=True).start())
    q.awaitTermination()


def test_late_rows_dropped_after_watermark(spark):
    d = tempfile.mkdtemp(prefix="run-")
    os.makedirs(f"{d}/in")
    base = dt.datetime(2024, 1, 10)
    spark.createDataFrame([(1, base, "positive"), (2, base + dt.timedelta(days=5), "positive")], SCH) \
        .coalesce(1).write.parquet(f"{d}/in/b1")
    schema = T._parse_datatype_string(SCH)

    def stream():
        s = LV.review_stream(spark, f"{d}/in/*", schema)
        return LV.windowed_sentiment(s, "timestamp", "final_sentiment", "1 day", watermark="1 day")

    _run(spark, stream(), f"{d}/ck", f"{d}/out")          # first run: watermark -> day 14
    spark.createDataFrame([(3, base + dt.timedelta(days=5, hours=1), "negative"),
                           (4, base - dt.timedelta(days=4), "negative")], SCH).coalesce(1).write.parquet(f"{d}/in/b2")
    _run(spark, stream(), f"{d}/ck", f"{d}/out")          # restart from the checkpoint
    out = RunTable(spark, f"{d}/out", KEYS).read()
    neg = out.filter(F.col("final_sentiment") == "negative").agg(F.sum("n")).first()[0]
    pos = out.filter(F.col("final_sentiment") == "positive").agg(F.sum("n")).first()[0]
    assert neg == 1 and pos == 2  # the late negative row was dropped; nothing counted twice


def test_dedup_across_restart(spark):
    d = tempfile.mkdtemp(prefix="run-")
    os.makedirs(f"{d}/in")
    base = dt.datetime(2024, 1, 10)
    rows = [(1, base, "positive"), (2, base, "negative")]
    spark.createDataFrame(rows, SCH).coalesce(1).write.parquet(f"{d}/in/b1")
    schema = T._parse_datatype_string(SCH)

    def run():
        s = LV.dedup_replays(LV.review_stream(spark, f"{d}/in/*", schema), "review_id", "timestamp", "1 day")
        q = (s.writeStream.option("checkpointLocation", f"{d}/ck").format("parquet")
             .option("path", f"{d}/out").trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    spark.createDataFrame(rows, SCH).coalesce(1).write.parquet(f"{d}/in/b2")  # replayed delivery
    run()
    assert spark.read.parquet(f"{d}/out").count() == 2


def test_drift_counter_across_restart_and_rerun(spark):
    d = tempfile.mkdtemp(prefix="run-")
    schema = T._parse_datatype_string("key long, event_id long, ts timestamp_ntz")
    base = dt.datetime(2024, 1, 1)
    rows = [(1 if i % 4 else 2, i, base + dt.timedelta(hours=i)) for i in range(60)]
    fn = LV.drift_counter_batches(f"{d}/out", "key", reset_at=10)
    for n, part in enumerate((rows[:25], rows[25:40], rows[40:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{d}/in")
        s = LV.review_stream(spark, f"{d}/in", schema)
        q = (s.writeStream.option("checkpointLocation", f"{d}/ck").foreachBatch(fn)
             .trigger(availableNow=True).start())  # a restart from the checkpoint each time
        q.awaitTermination()
    fn(spark.createDataFrame(rows[40:], schema), 2)  # the last batch once more
    got = spark.read.parquet(f"{d}/out/rows").collect()
    want = {}
    for k, i, _ in rows:
        n = want.setdefault(k, [])
        n.append((i, len(n) % 10, len(n) > 0 and len(n) % 10 == 0))
    assert sorted((r.key, r.event_id, r.drift_counter, r.triggered) for r in got) == \
        sorted((k, *x) for k, xs in want.items() for x in xs)


def _bytes(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


def test_newest_rows_hold_over_levels(spark):
    d = tempfile.mkdtemp(prefix="run-")
    table, want = RunTable(spark, f"{d}/t", ["k"], fan=3), {}
    for b in range(11):
        part = [(b, b), (b // 2, 100 + b), (None, b)]
        part = list({k: (k, n) for k, n in part}.values())
        df = spark.createDataFrame(part, "k long, n long")
        table.add(df, b)
        table.add(df, b)  # a batch run again changes nothing
        want.update(dict(part))
        assert {r.k: r.n for r in table.read().collect()} == want
    runs = CommitLog(spark, f"{d}/t/_log").latest()[1]["runs"]
    assert [r["level"] for r in runs] == [2, 0, 0]  # 9 batches in one run, two more


def test_bytes_follow_the_batch(spark):
    """A small batch on a large table writes a small run."""
    d = tempfile.mkdtemp(prefix="run-")
    table = RunTable(spark, f"{d}/t", ["k"])
    table.add(spark.range(200_000).select(F.col("id").alias("k"), F.rand(1).alias("n")), 0)
    large = _bytes(f"{d}/t")
    table.add(spark.createDataFrame([(5, 1.0)], "k long, n double"), 1)
    assert _bytes(f"{d}/t") - large < large / 100
    assert table.read().count() == 200_000 and table.read().where("k = 5").first().n == 1.0


def test_batch_that_failed_before_its_commit(spark):
    d = tempfile.mkdtemp(prefix="run-")
    table = RunTable(spark, f"{d}/t", ["k"], ["n"])
    table.add(spark.createDataFrame([(1, 2)], "k long, n long"), 0)
    # files of a try that never committed
    spark.createDataFrame([(1, 99)], "k long, n long").write.parquet(f"{d}/t/level-0/batch-1")
    assert table.read().first().n == 2
    table.add(spark.createDataFrame([(1, 3), (2, 1)], "k long, n long"), 1)
    assert sorted(map(tuple, table.read().collect())) == [(1, 5), (2, 1)]
    table.add(spark.createDataFrame([(1, -5)], "k long, n long"), 2)
    assert list(map(tuple, table.read().collect())) == [(2, 1)]  # nothing left of key 1


def test_panels_follow_added_and_retracted_reviews(spark):
    """Every panel over the sums of several batches equals the panel over
    the reviews that are left."""
    sf = "/root/testdata/sf0.001"
    rows = td.review_facts(spark, sf).select("l_orderkey", "product_id", "final_sentiment", "timestamp", "rating",
                                             "helpful_vote")
    d = tempfile.mkdtemp(prefix="run-")
    fn = LV.panel_batches(f"{d}/t", "op")
    for b in range(5):
        new = rows.where(F.col("l_orderkey") % 5 == b).withColumn("op", F.lit(1))
        old = rows.where((F.col("l_orderkey") % 5 == b - 1) & (F.col("l_orderkey") % 3 == 0)).withColumn("op", F.lit(-1))
        fn(new.unionByName(old), b)
    left = rows.where((F.col("l_orderkey") % 3 != 0) | (F.col("l_orderkey") % 5 == 4))
    dims = td.products(spark, sf), td.categories(spark, sf)
    sums = LV.panel_table(spark, f"{d}/t").read()
    for name, panel in D.PANELS.items():
        assert sorted(map(str, panel(sums, *dims).collect())) == sorted(map(str, panel(left, *dims).collect())), name
    assert sorted(map(str, D.product_avg_rating(sums, dims[0]).collect())) == \
        sorted(map(str, D.product_avg_rating(left, dims[0]).collect()))


def test_late_metadata_labels_once_within_the_bound(spark):
    d = tempfile.mkdtemp(prefix="run-")
    t0 = dt.datetime(2024, 1, 1)
    r_sch = "row_id long, rating double, title string, text string, parent_asin string, review_time timestamp"
    m_sch = "main_category string, title string, store string, price double, parent_asin string, metadata_time timestamp"
    reviews = [(1, 5.0, "t", "great stuff", "a", t0), (2, 1.0, "t", "awful", "b", t0), (3, 5.0, "t", "fine", "c", t0),
               (4, 5.0, "t", None, "a", t0)]
    first = [("cat", "A", "s", 1.0, "a", t0 + dt.timedelta(hours=5)), ("cat", "B", "s", 1.0, "b", t0 + dt.timedelta(hours=30))]
    again = [("cat", "A2", "s", 1.0, "a", t0 + dt.timedelta(hours=6))]

    def write(rows, schema, folder):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{d}/{folder}")

    write([], r_sch, "r")
    write([], m_sch, "m")
    out = LV.label_late_metadata(LV.review_stream(spark, f"{d}/r", T._parse_datatype_string(r_sch)),
                                 LV.review_stream(spark, f"{d}/m", T._parse_datatype_string(m_sch)),
                                 "review_time", "metadata_time", "1 day")
    path = LV.run_available_now(out, "late", arrivals=[
        lambda: write(reviews, r_sch, "r"), lambda: write(first, m_sch, "m"), lambda: write(again, m_sch, "m")])
    got = {r.row_id: (r.product_title, r.heuristic_sentiment) for r in spark.read.parquet(path).collect()}
    assert got == {1: ("A", "neutral")} or got == {1: ("A", "positive")}  # b came too late, c never
    assert spark.read.parquet(path).count() == 1
