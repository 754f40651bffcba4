"""Document fingerprints by winnowing.

Rolling hashes of all k-grams of code points; in each window of ``window``
consecutive k-grams the smallest hash is selected, the rightmost one on
ties.  Positions are kept, so any passage of at least ``k + window - 1``
code points that two texts share gives them a common selected hash whose
positions locate the match.  Texts with fewer k-grams than a window are one
window; texts shorter than k have one hash of the whole text at position 0;
the empty text has no hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, texts_of

K = 16
WINDOW = 49
#: Multiplier of the rolling polynomial (odd), modulo 2^64.
BASE = 0x9E3779B97F4A7C15


def kgram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all k-grams: the polynomial sum(c[i+j] * BASE^(k-1-j))
    modulo 2^64, rolled over the whole text by doubling the gram length, then
    mixed and cut to its upper half."""
    n = len(points) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part = points.astype(np.uint64) + np.uint64(1)  # grams of length 1, 2, 4, ...
    size, out, have = 1, None, 0
    while True:
        if k & size:
            if out is None:
                out = part
            else:  # gram of `have` code points followed by one of `size`
                m = len(points) - have - size + 1
                out = out[:m] * np.uint64(pow(BASE, size, 1 << 64)) + part[have:have + m]
            have += size
        if 2 * size > k:
            break
        m = len(part) - size
        part = part[:m] * np.uint64(pow(BASE, size, 1 << 64)) + part[size:size + m]
        size *= 2
    h = out[:n]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(29))) >> np.uint64(32)


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) selected from ``text``, by position."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    h = kgram_hashes(points, min(k, len(points)))
    # smallest hash first, then the largest position
    low = (h << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(len(h), dtype=np.uint64))
    width, span = min(window, len(h)), 1
    while span < width:  # minima of ever longer windows
        step = min(span, width - span)
        low = np.minimum(low[:len(low) - step], low[step:])
        span += step
    chosen = low[np.r_[True, low[1:] != low[:-1]]]
    return (np.uint64(0xFFFFFFFF) - (chosen & np.uint64(0xFFFFFFFF))).astype(np.int64), chosen >> np.uint64(32)


def to_string(positions: np.ndarray, hashes: np.ndarray) -> str:
    """``position:hash`` pairs joined by spaces (hash: 8 hex digits)."""
    return " ".join(map("%d:%08x".__mod__, zip(positions.tolist(), hashes.tolist())))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sorted sets of hashes; two empty sets are alike."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


#: Documents of a range of ids, about.
RANGE_ROWS = 100_000


def _range_heads(spark: SparkSession, ids: DataFrame) -> list[int]:
    """Largest id of each range of ids, descending; a range for every
    ``RANGE_ROWS`` rows, at least as many as shuffle partitions.  Only these
    bounds reach the driver."""
    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for b in batches:
            for v in (pa.compute.max(b.column(0)).as_py(),):
                best = v if best is None or (v is not None and v > best) else best
        yield pa.RecordBatch.from_arrays([pa.array([best], pa.int64())], names=["top"])

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-ids.count() // RANGE_ROWS))
    rows = ids.repartitionByRange(n, "id").mapInArrow(top, "top bigint").where("top is not null").distinct().collect()
    return sorted((r.top for r in rows), reverse=True)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprint of every text and of its edited text, whose last third of
    code points is replaced by as many of the next document's first.

    The next document has the next smaller id; ties go by text, null ids come
    last, and after the last comes the first (a lone document follows
    itself).  A null text is empty.  Returns ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``,
    one row per row.  Texts cross the network once: rows are dealt by id
    range, and each range gets the first document of the next range."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("bigint").alias("id"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    heads = _range_heads(spark, src.select("id"))
    tops = np.array(heads[::-1], np.int64)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        if not len(tops):
            return pd.Series(np.zeros(len(ids), np.int32))
        known = ids.fillna(tops[0]).astype("int64")  # null ids: with the smallest
        return pd.Series((len(tops) - 1 - np.searchsorted(tops, known)).astype(np.int32))

    order = heads or [None]
    follows = spark.createDataFrame([(i, order[(i + 1) % len(order)]) for i in range(len(order))],
                                    "part int, head bigint")
    # one row per range: an id for RANGE_ROWS documents
    first = (src.join(F.broadcast(follows), src["id"].eqNullSafe(follows["head"]))
                .groupBy("part", "id").agg(F.min("text").alias("text"))
                .select("part", F.lit(1).alias("role"), "id", "text"))
    rows = src.select(range_of("id").alias("part"), F.lit(0).alias("role"), "id", "text").unionAll(first)
    rows = (rows.repartitionById(max(1, len(order)), F.col("part"))  # a task for every range
                .sortWithinPartitions("part", "role", F.col("id").desc_nulls_last(), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prev = None  # (id, text, fingerprint string, hash set) of a row whose next is awaited
        for b in slices(batches):
            out = []
            for role, i, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), texts_of(b.column(3))):
                pos, h = winnow(text, k, window)
                mine = (i, text, "" if role else to_string(pos, h), np.unique(h))
                if prev is not None:
                    cut = len(prev[1]) // 3
                    edited = prev[1][:len(prev[1]) - cut] + text[:cut]
                    pos, h = winnow(edited, k, window)
                    out.append((prev[0], len(prev[1]), hashlib.sha256(edited.encode()).hexdigest(), prev[2],
                                to_string(pos, h), likeness(prev[3], np.unique(h)), likeness(prev[3], mine[3])))
                prev = None if role else mine
            cols = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(),
                                                       pa.string(), pa.float64(), pa.float64()))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       "near_edited", "near_next"])

    return rows.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")
