"""Positions from file metadata against the order of the rows written."""

import re

from pyspark.sql import functions as F

from revlens.sources import io as IO
from revlens.sources import testdata as td


def _files(spark, tmp_path, sizes):
    """Several files of one table, read one by one for the plain order."""
    base = f"{tmp_path}/t"
    lo = 0
    for k, n in enumerate(sizes):
        spark.range(lo, lo + n).select((F.lit(10**6) - F.col("id")).alias("v"), F.lit("x").alias("_path")) \
            .coalesce(1).write.mode("append").parquet(f"{base}/k={k}")
        lo += n
    return base


def test_positions_follow_files_and_rows(spark, tmp_path):
    base = _files(spark, tmp_path, [5, 0, 700, 1])
    got = {r.v: r.row_id for r in IO.read_positions(spark, base).collect()}
    assert got == {10**6 - i: i for i in range(706)}
    df = IO.read_positions(spark, base, name="V", start=3)  # a column of that name is replaced
    assert sorted(df.columns) == ["V", "_path", "k"] and sorted(r.V for r in df.collect()) == list(range(3, 709))


def test_filters_and_splits_do_not_move_positions(spark, tmp_path):
    base = _files(spark, tmp_path, [3000, 2000])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        some = IO.read_positions(spark, base).filter("v < 996000")
        assert sorted(r.row_id for r in some.collect()) == list(range(4001, 5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_empty_table_and_first_rows(spark, tmp_path):
    base = _files(spark, tmp_path, [0])
    assert IO.read_positions(spark, base).count() == 0 and IO.first_rows(spark, base, 3).count() == 0
    more = _files(spark, tmp_path / "m", [4, 9])
    assert [r.v for r in IO.first_rows(spark, more, 6).collect()] == [10**6 - i for i in range(6)]


def test_many_files_are_joined_by_path(spark, tmp_path, monkeypatch):
    base = _files(spark, tmp_path, [5, 6])
    monkeypatch.setattr(IO, "FILES_EVERYWHERE", 1)
    assert sorted(r.row_id for r in IO.read_positions(spark, base).collect()) == list(range(11))


def test_rows_are_not_exchanged(spark):
    """Only one row per file and task crosses an exchange, not the reviews."""
    df = td.review_facts(spark, "/root/testdata/sf0.001", row_ids=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    fact_side = plan[:plan.index("BroadcastQueryStage") if "BroadcastQueryStage" in plan else plan.index("BroadcastExchange")]
    assert "Sort" not in fact_side and not re.search(r"Exchange (hash|range)", fact_side)
