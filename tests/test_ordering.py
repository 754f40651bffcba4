"""Distributed rank / running sum against brute force, with a hot group."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from revlens.operators.ordering import (positions, rank_by_shuffle_key, rank_within, running_sum,
                                        top_k_per_group, with_row_id)


def _data(spark, n=5000):
    rnd = random.Random(7)
    rows = [(i, "hot" if rnd.random() < 0.6 else f"g{rnd.randint(0, 30)}", rnd.randint(0, 200)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, g string, v long")


def test_rank_within_matches_row_number(spark):
    df = _data(spark)
    got = rank_within(df, ["v", "id"], by=["g"], name="rn")
    want = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    j = got.join(want, ["id", "g", "v"])
    assert j.count() == df.count()
    assert j.filter(F.col("rn") != F.col("rn2")).count() == 0


def test_row_id_dense(spark):
    df = _data(spark, 3000)
    ids = sorted(r.row_id for r in with_row_id(df, ["v", "id"]).collect())
    assert ids == list(range(3000))


def test_shuffle_rank(spark):
    df = _data(spark, 2000)
    got = rank_by_shuffle_key(df, "id", 42, by=["g"], name="rn")
    key = F.md5(F.concat(F.lit("42:"), F.col("id").cast("string")))
    want = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy(key, "id")))
    assert got.join(want, ["id", "g", "v"]).filter("rn != rn2").count() == 0


def test_running_sum(spark):
    df = _data(spark).groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    got = running_sum(df, "v", ["c"], by=["g"], prefix="cum_")
    w = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("cum2", F.coalesce(F.sum("c").over(w), F.lit(0)))
    assert got.join(want, ["g", "v", "c"]).filter("cum_c != cum2").count() == 0


def test_tied_first_key_spreads_over_ranges(spark):
    # two distinct first keys over 20 000 rows: ranges follow the whole order
    df = spark.range(20_000).select((F.col("id") % 2).alias("v"), "id")
    sizes = [r.n for r in positions(df, ["v", "id"], rows_per_range=1000)
             .groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) >= 15 and max(sizes) <= 3000 and sum(sizes) == 20_000


def test_ranges_match_row_number(spark):
    df = _data(spark).withColumn("g", F.when(F.col("g") != "g3", F.col("g")))  # a null group too
    got = rank_within(df, ["v", "id"], by=["g"], name="rn", rows_per_range=300)
    want = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    j = got.join(want.select("id", "rn2"), "id")
    assert j.count() == df.count() and j.filter("rn <> rn2").count() == 0
    agg = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    cum = running_sum(agg, "v", ["c"], by=["g"], prefix="cum_", inclusive=True, rows_per_range=40)
    w = Window.partitionBy("g").orderBy("v")
    want = agg.withColumn("cum2", F.sum("c").over(w)).select(F.col("g").alias("g2"), F.col("v").alias("v2"), "cum2")
    j = cum.join(want, cum.g.eqNullSafe(want.g2) & (cum.v == want.v2))
    assert j.count() == agg.count() and j.filter("cum_c <> cum2").count() == 0


def test_top_k_leaves_the_session_alone(spark):
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(key, None)
    df = _data(spark)
    got = top_k_per_group(df, ["g"], ["v", "id"], 1500)
    want = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy("v", "id"))).filter("rn2 <= 1500")
    j = got.join(want, ["id", "g", "v"])
    assert got.count() == want.count() == j.count() and j.filter("rn <> rn2").count() == 0
    assert spark.conf.get(key, None) == before
