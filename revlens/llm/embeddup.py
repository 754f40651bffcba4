"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned into the eigenbasis of their
second moments, largest first.  Vectors closer than the threshold differ by
at most ``sqrt(2 - 2 t)`` in every coordinate, so a grid of that width over
the first coordinates leaves only neighbouring cells to compare.  Cells are
cut into tiles of bounded size, tiles are dealt to blocks, and a task gets the
tiles of two blocks that have neighbours in the other, so a tile moves once
for each block and not once for each neighbour; block pairs take turns, so
that the moved tiles never fill the disk.  A pair of neighbouring tiles
multiplies the leading coordinates first; where that product plus the product
of the remaining norms cannot reach the threshold the pair of vectors is
dropped, the others take further coordinates, and what is left is compared in
double precision in the original coordinates.

A tile pair returns link counts per vector and a spanning forest of its
links, never the links themselves; equal vectors are compared once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ..session import materialize, release
from .common import connected_components

#: Coordinates of the grid, and vectors per tile (bounds a task's memory).
GRID_DIMS = 3
TILE_ROWS = 4096
#: Numbers in the vectors of a block (bounds a task's memory), and blocks at least (for enough tasks).
BLOCK_VALUES, BLOCKS = 1 << 21, 6
#: Bytes of tiles that move in one turn, if the tiles themselves are not more.
TURN_BYTES = 1 << 28
#: Grids of at most so many cells are broadcast.
SMALL_SIDE = 100_000
#: Room for rounding in the bounds; what passes is compared exactly.
SLACK = 1e-5
#: Pairs compared exactly at a time.
EXACT = 1 << 15


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, d)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one (by their largest entry first, so that
    neither huge nor tiny vectors lose their norm)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def second_moments(classes: DataFrame, d: int) -> np.ndarray:
    """Sum of u u^T over the unit vectors; d^2 numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for b in batches:
            u = unit(_matrix(b.column(0), d))
            total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                                         names=["i", "row"])

    rows = (classes.select("v").mapInArrow(run, "i int, row array<double>")
                   .select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")))
    out = np.zeros((d, d))
    for r in rows.collect():
        out[r.i, r.j] = r.x
    return out


class Side:
    """Unit vectors ``u`` with their coordinates ``p`` in ``basis``, the norms
    behind the first ``cuts`` of these, and the leading coordinates."""

    def __init__(self, u: np.ndarray, basis: np.ndarray):
        d = u.shape[1]
        self.u, self.p = u, u @ basis
        self.cuts = sorted({min(d, c) for c in (max(1, d // 4), max(1, d // 2))})
        self.norms = [np.sqrt(np.maximum(0, (self.p[:, c:] ** 2).sum(axis=1))) for c in self.cuts]
        # the norm of the rest as one more coordinate: a product of two rows is their bound
        self.lead = np.column_stack([self.p[:, :self.cuts[0]], self.norms[0]]).astype(np.float32)


def compare(a: np.ndarray, b: np.ndarray, basis: np.ndarray, threshold: float, same: bool):
    """Index pairs (i, j) of rows of ``a`` and ``b`` (unit vectors) with
    cosine of at least ``threshold``; ``same``: both are one tile, i < j."""
    return meet(Side(a, basis), Side(b, basis), threshold, same)


def meet(a: Side, b: Side, threshold: float, same: bool):
    """``compare`` of prepared tiles."""
    fb = np.ascontiguousarray(b.lead.T)
    limit = threshold - SLACK
    out_i, out_j = [], []
    for lo in range(0, len(a.u), 512):
        bound = a.lead[lo:lo + 512] @ fb
        i, j = np.divmod(np.flatnonzero(bound >= np.float32(limit)), len(b.u))
        i = i + lo
        if same:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), EXACT):
            x, y = i[at:at + EXACT], j[at:at + EXACT]
            part, done = np.zeros(len(x)), 0
            for k, c in enumerate(a.cuts):  # more coordinates for those still in reach
                part = part + np.einsum("ij,ij->i", a.p[x, done:c], b.p[y, done:c])
                live = part + a.norms[k][x] * b.norms[k][y] >= limit
                x, y, part, done = x[live], y[live], part[live], c
            hit = np.einsum("ij,ij->i", a.u[x], b.u[y]) >= threshold
            out_i.append(x[hit])
            out_j.append(y[hit])
    if not out_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_i), np.concatenate(out_j)


def forest(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Numbers of links (i, j) that span the same components as all."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    keep = []
    for n, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        a, b = find(x), find(y)
        if a != b:
            root[b] = a
            keep.append(n)
    return np.array(keep, np.int64)


def _links(classes: DataFrame, d: int, n: int, threshold: float) -> DataFrame:
    """``node, other, n``: link counts (other null) and forest links (n null)
    between ``n`` classes ``c, v, copies`` of vectors of length ``d``."""
    kind = np.dtype("<f4" if classes.schema["v"].dataType.elementType == FloatType() else "<f8")
    blocks = max(BLOCKS, math.ceil(n / max(TILE_ROWS, BLOCK_VALUES // d)))
    values, vectors = np.linalg.eigh(second_moments(classes, d))
    basis = vectors[:, np.argsort(-values)]
    dims, width = min(GRID_DIMS, d), math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.floor(unit(_matrix(b.column(1), d)) @ basis[:, :dims] / width).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(at), pa.list_(pa.int32()))],
                                             names=[*b.schema.names, "cell"])

    placed = classes.mapInArrow(cells, f"c bigint, v {classes.schema['v'].dataType.simpleString()}, copies bigint, "
                                       "cell array<int>")
    cells_most = (2 / width + 2) ** dims  # coordinates lie in [-1, 1]
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).cast("int").alias("chunks"))
    if cells_most <= SMALL_SIDE:
        sizes = F.broadcast(sizes)
    # dealt by chunk, else a join by cell leaves all chunks of a hot cell in one task
    dealt = (placed.join(sizes, "cell")
                   .withColumn("chunk", F.pmod(F.xxhash64("c"), F.col("chunks")).cast("int"))
                   .repartition("cell", "chunk"))

    def pack(key, t):  # (cell, chunk) and its vectors -> one row
        t = t.sort_by("c")
        x = _matrix(t.column("v").combine_chunks(), d).astype(kind)
        return pa.table({"cell": pa.array([key[0].as_py()], pa.list_(pa.int32())), "chunk": [key[1].as_py()],
                         "rows": [t.num_rows],
                         "c": pa.array([np.asarray(t.column("c"), np.int64).tobytes()], pa.binary()),
                         "copies": pa.array([np.asarray(t.column("copies"), np.int64).tobytes()], pa.binary()),
                         "x": pa.array([x.tobytes()], pa.binary())},
                        schema=pa.schema([("cell", pa.list_(pa.int32())), ("chunk", pa.int32()), ("rows", pa.int64()),
                                          ("c", pa.binary()), ("copies", pa.binary()), ("x", pa.binary())]))

    packed = dealt.groupBy("cell", "chunk").applyInArrow(
        pack, "cell array<int>, chunk int, rows bigint, c binary, copies binary, x binary")
    tiles = materialize(packed.withColumn("block", F.pmod(F.xxhash64("cell", "chunk"), F.lit(blocks)).cast("int")),
                        "tiles", tidy=True)
    # the blocks that hold a cell or one of its neighbours
    held = tiles.select("cell", "block").distinct()
    step = F.array(*[F.lit(s) for s in (-1, 0, 1)])
    near = tiles.select("cell").distinct()
    for k in range(dims):
        near = near.withColumn(f"s{k}", F.explode(step))
    other = F.array(*[F.col("cell")[k] + F.col(f"s{k}") for k in range(dims)])
    near = (near.select(F.col("cell").alias("of"), other.alias("cell")).join(held, "cell")
                .groupBy(F.col("of").alias("cell")).agg(F.collect_set("block").alias("others")))
    near = materialize(near, "near", tidy=True)
    moved = tiles.join(near, "cell").agg(F.sum(F.col("rows") * F.size("others"))).first()[0] or 0
    row_bytes = d * kind.itemsize + 16
    turns = max(1, math.ceil(moved * row_bytes / max(n * row_bytes, TURN_BYTES)))
    meetings = blocks * (blocks + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The tiles of a block pair, those of its first block before the others."""
        now, first = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                ba, bb, block, cell, c, copies, x = (v[k].as_py() for v in batch.columns)
                if now != (ba, bb):
                    now, first = (ba, bb), []
                cell = np.array(cell)
                c, copies = np.frombuffer(c, np.int64), np.frombuffer(copies, np.int64)
                tile = cell, c, copies, Side(unit(np.frombuffer(x, kind).reshape(-1, d).astype(np.float64)), basis)
                if block == ba:
                    first.append(tile)
                if block == bb:
                    for mate in first:
                        if np.abs(mate[0] - cell).max() <= 1:
                            yield from linked(mate, tile, mate is tile)

    def linked(one, two, same: bool) -> Iterator[pa.RecordBatch]:
        (_, ca, na, a), (_, cb, nb, b) = one, two
        i, j = meet(a, b, threshold, same)
        if not len(i):
            return
        node = np.concatenate([ca[i], cb[j]])
        weight = np.concatenate([nb[j], na[i]])
        nodes, inv = np.unique(node, return_inverse=True)
        count = np.bincount(inv, weight, len(nodes)).astype(np.int64)
        keep = forest(ca[i], cb[j])
        n, m = len(nodes), len(keep)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([nodes, ca[i][keep]])),
             pa.array([None] * n + cb[j][keep].tolist(), pa.int64()),
             pa.array(count.tolist() + [None] * m, pa.int64())], names=["node", "other", "n"])

    if cells_most <= SMALL_SIDE:
        near = F.broadcast(near)
    found = []
    for turn in range(turns):
        ba, bb = F.least("block", "other"), F.greatest("block", "other")
        some = (tiles.join(near, "cell").withColumn("other", F.explode("others"))
                     .where(F.pmod(F.xxhash64(ba, bb), F.lit(turns)) == turn)
                     .select(ba.alias("ba"), bb.alias("bb"), "block", "cell", "c", "copies", "x", "chunk")
                     .repartition(max(1, math.ceil(meetings / turns)), "ba", "bb")
                     .sortWithinPartitions("ba", "bb", F.col("block") != F.col("ba"), "cell", "chunk")
                     .select("ba", "bb", "block", "cell", "c", "copies", "x"))
        found.append(materialize(some.mapInArrow(run, "node bigint, other bigint, n bigint"), "links", tidy=True))
    release(tiles)
    return reduce(DataFrame.unionAll, found)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = 0.95) -> DataFrame:
    """One row per vector row: ``vec_id, n_links, component_id, kept``.

    Null and zero vectors and those with null or non-finite components link
    with nothing, nor do vectors of different lengths; equal rows count as
    vectors of their own.  ``component_id`` is the smallest id reachable
    (null ids are never the smallest unless alone); ``kept``: it is the
    row's own.  An empty table gives an empty result."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    # floats stay floats: the same values in half the room
    plain = vectors.schema[vector_col].dataType
    kind = "float" if isinstance(plain, ArrayType) and plain.elementType == FloatType() else "double"
    src = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast(f"array<{kind}>").alias("v"))
    fine = (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("v", lambda x: x != 0)
    good = src.where(F.col("v").isNotNull()).where(fine)
    classes = materialize(good.groupBy("v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
                              .withColumn("c", F.monotonically_increasing_id()), "vectors", tidy=True)
    lengths = sorted(map(tuple, classes.groupBy(F.size("v")).count().collect()))
    found = None
    for d, n in lengths:
        part = _links(classes.where(F.size("v") == d).select("c", "v", "copies"), d, n, threshold)
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "node bigint, other bigint, n bigint")
    comps = connected_components(found.where("other is not null"), "node", "other")
    counts = found.where("n is not null").groupBy("node").agg(F.sum("n").alias("n"))
    tagged = (classes.join(comps, classes["c"] == comps["node"], "left").drop("node")
                     .join(counts, F.col("c") == counts["node"], "left")
                     .select("v", "least", "copies", F.coalesce("root", "c").alias("root"),
                             F.coalesce("n", F.lit(0)).alias("n")))
    least = tagged.groupBy("root").agg(F.min("least").alias("component"))
    tagged = tagged.join(least, "root").select(F.col("v").alias("of"), "copies", "n", "component")
    out = src.join(tagged, src["v"] == tagged["of"], "left")
    component = F.when(F.col("of").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce(F.col("n") + F.col("copies") - 1, F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
