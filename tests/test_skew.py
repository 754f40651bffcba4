"""Spread joins: same rows as a plain join, and no hot task."""

import pytest
from pyspark.sql import functions as F

from revlens.operators import quality as Q
from revlens.operators import skew as S


@pytest.fixture()
def shuffled(spark):
    """Joins by shuffle, partitions as planned."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _tables(spark, n=60_000):
    left = spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 101 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 3000)).alias("k"), F.lit("l").alias("salt"))
    right = spark.range(3100).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v"))
    hot = spark.createDataFrame([("hot", -1), ("hot", -2), (None, -3)], "k string, v long")
    return left, right.unionByName(hot)


def test_sketch_finds_the_heavy_keys(spark):
    left, _ = _tables(spark)
    got = {r.k: r.share for r in S.heavy_keys(left, "k").collect()}
    assert set(got) == {"hot"} and 0.33 < got["hot"] < 0.34
    numbers = spark.range(1000).select((F.col("id") % 2 * 7).alias("n"))
    assert sorted(r.n for r in S.heavy_keys(numbers, "n").collect()) == [0, 7]
    assert S.heavy_keys(left.limit(0), "k").count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_as_a_plain_join(shuffled, how):
    left, right = _tables(shuffled, 6000)
    got = S.spread_join(left, right, "k", how=how)
    assert got.columns == ["k", "id", "salt", "v"]
    assert sorted(map(str, got.collect())) == sorted(map(str, left.join(right, "k", how).collect()))


def test_no_task_holds_over_twice_the_median(shuffled):
    left, right = _tables(shuffled)

    def sizes(df):
        rows = df.groupBy(F.spark_partition_id()).count().collect()
        return sorted(r["count"] for r in rows)

    plain = sizes(left.join(right.where("v <> -2"), "k"))
    spread = sizes(S.spread_join(left, right.where("v <> -2"), "k", by=["id"]))
    assert plain[-1] > 3 * plain[len(plain) // 2]  # the case is a hot one
    assert spread[-1] <= 2 * spread[len(spread) // 2] and sum(spread) == sum(plain)


def test_quality_counted_during_the_write(spark, tmp_path):
    rows = [("1", 0), ("x", 1), (None, 1), ("3", 9), ("4", None)]
    df = spark.createDataFrame(rows, "a string, label int").repartition(3)
    declared = Q.T._parse_datatype_string("a long, label int, gone string")
    report, classes = Q.observed_write(df, f"{tmp_path}/t", declared, "label")
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, Q.value_report(df, declared).collect()))
    assert sorted(map(tuple, classes.collect()), key=str) == [(0, 1), (1, 2), (None, 2)]
    assert spark.read.parquet(f"{tmp_path}/t").count() == 5
    none = Q.observed_write(df.limit(0), f"{tmp_path}/e", declared, "label")
    assert {r.n for r in none[0].collect()} == {0} and none[1].count() == 0
