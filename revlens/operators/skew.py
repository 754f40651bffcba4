"""Joins that spread hot keys.

A mergeable sketch of frequent items finds the keys that hold a noticeable
share of the rows in one pass over the key column.  Only their rows are
salted: the large side's by a hash of the row, the small side's by one copy
per salt.  The sketch only decides what is spread, so its error changes no
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fresh_name
from ..session import materialize

#: A key is hot from this share of the rows on (one in so many): never more
#: keys than this, so their list may be broadcast.
HOT_ONE_IN = 1000
#: Counters of the sketch; a count is off by at most about 4 in so many rows.
TRACKED = 100_000
#: Parts of a hot key per partition that its share of the rows would fill.
PARTS = 8


def heavy_keys(df: DataFrame, key: str, one_in: int = HOT_ONE_IN) -> DataFrame:
    """``key, share``: keys with at least one in ``one_in`` of the rows that
    have a key (at most ``one_in`` rows).  Tasks send fixed-size sketches."""
    kind = df.schema[key].dataType
    sketch = df.where(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").cast("string").alias("k")).agg(
        F.expr(f"approx_top_k(k, {one_in}, {max(TRACKED, one_in)})").alias("top"), F.count(F.lit(1)).alias("n"))
    rows = sketch.select("n", F.explode("top").alias("t"))
    return rows.where(F.col("t.count") * one_in >= F.col("n")).select(
        F.col("t.item").cast(kind).alias(key), (F.col("t.count") / F.col("n")).alias("share"))


def spread_join(left: DataFrame, right: DataFrame, key: str, by: list[str] | None = None, how: str = "inner",
                one_in: int = HOT_ONE_IN) -> DataFrame:
    """``left.join(right, key, how)`` (inner or left) with hot keys of the
    large ``left`` side dealt over many tasks; ``by`` are columns whose hash
    tells the rows of a key apart (default: all).

    A hot key has `PARTS` parts for each shuffle partition that its rows
    would fill, so parts stay small beside a partition.  Null keys join
    nothing, as in any join."""
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins copy the right side")
    spark = left.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt, parts = fresh_name(left, right, "salt"), fresh_name(left, right, "parts")
    hot = materialize(heavy_keys(left, key, one_in).select(
        key, F.greatest(F.lit(2), F.ceil(F.col("share") * partitions * PARTS)).cast("int").alias(parts)), "hot-keys")
    hot = F.broadcast(hot)
    drawn: Column = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by or left.columns]), F.col(parts)).cast("int")
    many = left.join(hot, key, "left").withColumn(salt, F.coalesce(drawn, F.lit(0))).drop(parts)
    each = right.join(hot, key, "left").withColumn(
        salt, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(parts), F.lit(1)) - 1))).drop(parts)
    return many.join(each, [key, salt], how).drop(salt)
