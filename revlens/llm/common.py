"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize, ship_package


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder set, package importable in Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out, n = name, 0
    while out.lower() in taken:
        n += 1
        out = f"{name}_{n}"
    return out


def texts_of(column) -> list[str]:
    """Strings of an Arrow column, null as the empty text."""
    return [t or "" for t in column.to_pylist()]


#: Rows of an Arrow batch that are Python objects at a time.
SLICE_ROWS = 500


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into short ones: texts become Python strings a slice
    at a time, so a worker holds few of them (an empty batch stays)."""
    for b in batches:
        for lo in range(0, max(1, b.num_rows), rows):
            yield b.slice(lo, rows)


def text_key(text: str):
    """Content key of a text column (null equals the empty text), used with
    the document id to tell rows that share an id apart."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


# --- connected components ----------------------------------------------------

def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a batch -> (node, smallest node of its set in the batch)."""
    for batch in batches:
        a = batch.column(0).to_numpy(zero_copy_only=False)
        b = batch.column(1).to_numpy(zero_copy_only=False)
        nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = np.arange(len(nodes))
        x, y = inv[:len(a)], inv[len(a):]
        while True:
            low = np.minimum(root[x], root[y])
            before = root.copy()
            np.minimum.at(root, root[x], low)
            np.minimum.at(root, root[y], low)
            root = root[root]
            if np.array_equal(before, root):
                break
        keep = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(nodes[root[keep]])],
                                         names=["hi", "lo"])


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of the undirected ``links`` (two bigint columns).

    Returns ``node, root`` for every node of a link between two different
    nodes; ``root`` is the smallest node of its component.  Nodes without
    such links have no row (their root is themselves).  Alternates the
    large-star and small-star steps; each round is written to the shared
    checkpoint folder, and only a row count and checksum reach the driver.
    """
    e = (links.select(F.col(a).alias("hi"), F.col(b).alias("lo"))
              .where("hi is not null and lo is not null and hi <> lo")
              .mapInArrow(_local_forest, "hi bigint, lo bigint"))
    e = materialize(e.distinct(), "links")
    seen = None
    while True:
        both = e.unionAll(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        low = both.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        # large star: every neighbour above u points to u's smallest neighbour
        big = (both.join(low, both.hi == low.u)
                   .where("lo > hi").select(F.col("lo").alias("hi"), F.least("m", "u").alias("lo")))
        # small star: neighbours below u, and u itself, point to the smallest
        low2 = big.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        nxt = (big.join(low2, big.hi == low2.u)
                  .select(F.explode(F.array(
                      F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")),
                      F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("p"))
                  .select("p.hi", "p.lo").where("hi <> lo").distinct())
        e = materialize(nxt, "links")
        state = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first())
        if state == seen:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = state
