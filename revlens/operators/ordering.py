"""Distributed positional operators: dense row ids and ranks within groups.

`row_number()` over a window without a partition (or partitioned by a key
that holds a third of the rows) runs in one task.  Here the rows are dealt
by ranges of the *whole* order - groups first, then every order column, so
neither a hot group nor a tied first key meets in one task - and sorted
inside each range.  The sorted rows are written once to the shared
checkpoint folder with their place in their range; a row's position is that
place plus the rows of the ranges before, and its rank the distance to its
group's first position.  The number of ranges follows the number of rows.
Since the copy is written, a recomputed task (lost executor, re-read) sees
the same numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: With n rows there are sqrt(n / RANGE_UNIT) ranges of sqrt(n * RANGE_UNIT) rows:
#: 25 for 600 000 rows, 32 000 of 32 million rows (sorted with spilling) for 10^12.
RANGE_UNIT = 1000
#: Bits of `monotonically_increasing_id` below its partition number.
_ID_BITS = 33


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def positions(df: DataFrame, order, name: str = "_pos", rows_per_range: int | None = None,
              copy: bool = True) -> DataFrame:
    """``df`` in ``order`` order with ``name`` = 0-based position of each row,
    and its range in ``_range``.  ``order`` should end with a unique key;
    rows that tie in all of it are numbered in any order.

    The input is read three times (count, sample of the order, sort), so it
    is written first; ``copy=False`` is for scans that are cheaper to repeat."""
    order = _cols(order)
    if copy:
        df = materialize(df, "unordered")
    n = df.count()
    ranges = max(1, math.ceil(n / rows_per_range if rows_per_range else math.sqrt(n / RANGE_UNIT)))
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = materialize(dealt.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_at", _ID_BITS)
    # one row per range
    sizes = placed.groupBy(part.alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start"))
    return (placed.withColumn("_range", part).join(starts, "_range")
                  .withColumn(name, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << _ID_BITS) - 1)))
                  .drop("_at", "_start"))


def rank_within(df: DataFrame, order, by=(), name: str = "rn", rows_per_range: int | None = None,
                copy: bool = True) -> DataFrame:
    """Add ``name`` = 1-based position of each row inside its ``by`` group in
    ``order`` order (``row_number()`` semantics; nulls are a group).

    ``order`` must be a total order (end it with a unique key)."""
    by = list(by)
    placed = positions(df, [*by, *order], rows_per_range=rows_per_range, copy=copy).drop("_range")
    if not by:
        return placed.withColumn(name, F.col("_pos") + 1).drop("_pos")
    first = placed.groupBy(*by).agg(F.min("_pos").alias("_first"))
    keys = [F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)]
    first = first.select(*keys, "_first")
    same = [placed[c].eqNullSafe(first[f"_by_{i}"]) for i, c in enumerate(by)]
    return (placed.join(first, same).withColumn(name, F.col("_pos") - F.col("_first") + 1)
                  .drop("_pos", "_first", *[f"_by_{i}" for i in range(len(by))]))


def with_row_id(df: DataFrame, order, name: str = "row_id", start: int = 0) -> DataFrame:
    """Dense, stable row id ``start, start+1, ...`` in ``order`` order.  Use a
    source key when the table has one (event_id, doc_id); this is for tables
    whose identity is positional."""
    return positions(df, order, name).drop("_range").withColumn(name, F.col(name) + F.lit(start))


def shuffle_key(row_id, seed: int = 42) -> Column:
    """K6: a reproducible pseudo-random order key, md5 of ``seed:row_id``.
    The same string is produced by SQL engines with an md5 function."""
    rid = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.md5(F.concat(F.lit(f"{seed}:"), rid.cast("string")))


def rank_by_shuffle_key(df: DataFrame, row_id: str = "row_id", seed: int = 42, by=(),
                        name: str = "rn") -> DataFrame:
    """Rank rows in md5 shuffle order (ties impossible: row id breaks them)."""
    keyed = df.withColumn("_key", shuffle_key(row_id, seed))
    return rank_within(keyed, ["_key", row_id], by=by, name=name).drop("_key")


def hash_int(key: Column) -> Column:
    """First 60 bits of md5(key) as a non-negative long."""
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


#: Parts of a group whose first rows are found apart before they meet.
_TOP_PARTS = 64


def top_k_per_group(df: DataFrame, by, order, k: int, name: str = "rn") -> DataFrame:
    """Rows ranked ``<= k`` inside each group.  Groups are cut into parts by
    a hash of the row, each part keeps its first ``k`` rows, and only those
    are ranked together: a hot group costs its task at most 64 k rows,
    whatever ``k`` is."""
    by, order = _cols(by), _cols(order)
    part = F.pmod(F.xxhash64(*df.columns), F.lit(_TOP_PARTS))
    own = Window.partitionBy(*by, "_part").orderBy(*order)
    few = (df.withColumn("_part", part).withColumn("_rank", F.row_number().over(own))
             .filter(F.col("_rank") <= k).drop("_part", "_rank"))
    return few.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col(name) <= k)


def running_sum(df: DataFrame, order_col: str, value_cols: list[str], by=(), prefix: str = "cum_",
                inclusive: bool = False, rows_per_range: int | None = None, copy: bool = True) -> DataFrame:
    """Cumulative sums of ``value_cols`` along ``order_col`` inside ``by``
    groups (rows with equal ``order_col`` must already be aggregated into one
    row).  ``inclusive=False`` sums strictly earlier rows.  Sums run inside
    ranges of the order and add what the group's earlier ranges hold, so no
    task meets a whole hot group."""
    by = list(by)
    placed = positions(df, [*by, order_col], rows_per_range=rows_per_range, copy=copy)
    tot = placed.groupBy("_range", *by).agg(*[F.sum(c).alias(f"_t_{c}") for c in value_cols])
    w_off = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(F.col("_range").alias("_of"), *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)],
                      *[F.coalesce(F.sum(f"_t_{c}").over(w_off), F.lit(0)).alias(f"_o_{c}") for c in value_cols])
    end = 0 if inclusive else -1
    w_loc = Window.partitionBy("_range", *by).orderBy(order_col).rowsBetween(Window.unboundedPreceding, end)
    loc = placed.select("*", *[F.coalesce(F.sum(c).over(w_loc), F.lit(0)).alias(f"_l_{c}") for c in value_cols])
    same = [loc["_range"] == offs["_of"], *[loc[c].eqNullSafe(offs[f"_by_{i}"]) for i, c in enumerate(by)]]
    j = loc.join(offs, same)
    return j.select(*[loc[c] for c in df.columns],
                    *[(F.col(f"_o_{c}") + F.col(f"_l_{c}")).alias(f"{prefix}{c}") for c in value_cols])
