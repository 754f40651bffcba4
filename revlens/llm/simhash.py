"""SimHash near-duplicate detection with bit-sliced distance counting.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its
word shingles.  Two fingerprints link when they differ in at most ``radius``
bits.  Candidates: the 64 bits are cut into ``radius + 5`` blocks; two
fingerprints within the radius agree on all but ``radius`` of them, so they
meet under one of the block subsets.  The key leaves at most 19 bits free
(radius 2), so a bucket of *distinct* fingerprints never exceeds 2^19
entries, whatever the data: copies are grouped before.  Inside a bucket the
fingerprints stand vertically (one machine word holds one bit of 64 of
them), and the distances from a query to 64 others grow together in
carry-save counters; a block whose 64 distances all exceed the radius is
abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import connected_components, fresh, slices, text_key

#: Shingle hashes summed at a time (bounds memory for very long texts).
CHUNK = 1 << 16
#: (query, block) pairs compared at a time.
PAIRS = 1 << 18


def simhash64(data: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint (unsigned) of a UTF-8 text: lower-cased A-Z, words split at
    ASCII white space, shingles with repeats.  No words: 0; fewer words than
    a shingle: the hash of the whole sequence."""
    words = data.lower().split()
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle))) if len(words) > shingle else [words]
    n = max(1, len(words) - shingle + 1)
    raw = b"".join(map(xxhash.xxh64_digest, map(b" ".join, grams), repeat(seed)))
    hashes = np.frombuffer(raw, np.uint8).reshape(n, 8)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, CHUNK):
        ones += np.unpackbits(hashes[lo:lo + CHUNK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3, seed: int = 42) -> DataFrame:
    """``id, key, fp``: one row per document row.  ``fp`` is the fingerprint's
    bits as a signed bigint; ``key`` the content key of the text.  A null
    text counts as empty."""
    src = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"),
                      F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = b.column("text").cast(pa.binary()).to_pylist()
            fp = np.fromiter((simhash64(t or b"", shingle, seed) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("key"), pa.array(fp.view(np.int64))],
                                             names=["id", "key", "fp"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, key bigint, fp bigint")


def block_masks(radius: int) -> list[tuple[frozenset, int, list[int]]]:
    """(free blocks, key mask, free bits) of each candidate table."""
    n = radius + 5
    edges = [round(64 * i / n) for i in range(n + 1)]
    out = []
    for free in combinations(range(n), radius):
        bits = [p for b in free for p in range(edges[b], edges[b + 1])]
        mask = (1 << 64) - 1
        for p in bits:
            mask &= ~(1 << p)
        out.append((frozenset(free), mask, bits))
    return out


def bit_sliced_pairs(fps: np.ndarray, bucket: np.ndarray, bits: list[int], radius: int):
    """Index pairs (i < j) of equal ``bucket`` whose ``fps`` differ in at most
    ``radius`` of the positions ``bits`` (``bucket`` is sorted)."""
    n = len(fps)
    start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if n else np.zeros(0, int)
    size = np.diff(np.r_[start, n])
    start, size = start[size > 1], size[size > 1]
    if not len(start):
        return np.zeros(0, int), np.zeros(0, int)
    # blocks of up to 64 lanes, never across buckets
    nblk = -(-size // 64)
    first = np.cumsum(nblk) - nblk
    total = int(nblk.sum())
    owner = np.repeat(np.arange(len(size)), nblk)
    within = np.arange(total) - first[owner]
    base = start[owner] + 64 * within
    lanes = np.minimum(64, size[owner] - 64 * within)
    at = base[:, None] + np.arange(64)
    at = np.minimum(at, n - 1)
    planes = np.empty((len(bits), total), np.uint64)
    for lo in range(0, total, 4096):
        block = fps[at[lo:lo + 4096]]
        for k, p in enumerate(bits):
            lane_bits = ((block >> np.uint64(p)) & np.uint64(1)).astype(np.uint8)
            planes[k, lo:lo + 4096] = np.packbits(lane_bits, axis=1, bitorder="little").view(np.uint64).ravel()
    # each member is a query against its own block and those after it
    members = np.repeat(start, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    of = np.repeat(np.arange(len(size)), size)
    own = first[of] + (members - start[of]) // 64
    todo = first[of] + nblk[of] - own
    ends = np.cumsum(todo)
    found_i, found_j = [], []
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    lo = 0
    while lo < len(members):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS, "right")))
        reps = todo[lo:hi]
        q = np.repeat(np.arange(lo, hi), reps)
        blk = own[q] + np.arange(len(q)) - np.repeat(np.cumsum(reps) - reps, reps)
        alive = np.where(lanes[blk] == 64, full, (np.uint64(1) << (lanes[blk] % 64).astype(np.uint64)) - np.uint64(1))
        lane = ((members[q] - start[of[q]]) % 64).astype(np.uint64)
        above = np.where(lane == 63, np.uint64(0), full << np.minimum(lane + np.uint64(1), np.uint64(63)))
        alive = np.where(blk == own[q], alive & above, alive)
        counters = [np.zeros(len(q), np.uint64) for _ in range(radius.bit_length())]
        fq = fps[members[q]]
        for k, p in enumerate(bits):
            live = alive != 0
            if not live.all():  # abandon blocks whose distances all exceed the radius
                q, blk, alive, fq = q[live], blk[live], alive[live], fq[live]
                counters = [c[live] for c in counters]
            if not len(q):
                break
            carry = planes[k, blk] ^ (np.uint64(0) - ((fq >> np.uint64(p)) & np.uint64(1)))
            for c in counters:  # carry-save addition of one bit to 64 counters
                c[...], carry = c ^ carry, c & carry
            over = carry  # past the counters' range
            # counter value > radius, compared bit by bit from the top
            equal, more = np.full(len(q), full), np.zeros(len(q), np.uint64)
            for b in reversed(range(len(counters))):
                r = full if (radius >> b) & 1 else np.uint64(0)
                more |= equal & counters[b] & ~r
                equal &= ~(counters[b] ^ r)
            alive = alive & ~(over | more)
        hit = np.flatnonzero(alive)
        if len(hit):
            flags = np.unpackbits(alive[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            r, lane = np.nonzero(flags)
            found_i.append(members[q[hit[r]]])
            found_j.append(base[blk[hit[r]]] + lane)
        lo = hi
    if not found_i:
        return np.zeros(0, int), np.zeros(0, int)
    return np.concatenate(found_i), np.concatenate(found_j)


def fingerprint_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``a, b`` between the different fingerprints in column ``fp`` that
    are at most ``radius`` bits apart; each pair once.  Nulls are ignored."""
    tables = block_masks(radius)
    distinct = fps.select("fp").where("fp is not null").distinct()
    signed = [m - (1 << 64) if m >> 63 else m for _, m, _ in tables]
    rows = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).cast("smallint").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
        for i, m in enumerate(signed)])).alias("s")).select(F.col("s.t").alias("t"), F.col("s.k").alias("k"), "fp")

    def of_bucket(t, k, fp):
        if not len(fp):
            return []
        free, _, bits = tables[t]
        i, j = bit_sliced_pairs(fp.view(np.uint64), k, bits, radius)
        if not len(i):
            return []
        a, b = fp[i], fp[j]
        # a pair meets under several subsets; it counts under the first one
        diff = (a ^ b).view(np.uint64)
        touched = np.zeros(len(a), np.int64)
        n = radius + 5
        edges = [round(64 * x / n) for x in range(n + 1)]
        for x in range(n):
            span = np.uint64(((1 << edges[x + 1]) - 1) ^ ((1 << edges[x]) - 1))
            touched |= ((diff & span) != 0).astype(np.int64) << x
        first = {}
        for bitset in np.unique(touched):
            need = {x for x in range(n) if bitset >> x & 1}
            first[int(bitset)] = next(i for i, (f, _, _) in enumerate(tables) if need <= f)
        mine = np.array([first[int(x)] == t for x in touched], bool)
        if not mine.any():
            return []
        return [pa.RecordBatch.from_arrays([pa.array(a[mine]), pa.array(b[mine])], names=["a", "b"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t0, k0, f0 = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            t = batch.column(0).to_numpy(zero_copy_only=False)
            k = batch.column(1).to_numpy(zero_copy_only=False)
            f = batch.column(2).to_numpy(zero_copy_only=False)
            cuts = np.r_[0, np.flatnonzero(t[1:] != t[:-1]) + 1, len(t)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi == lo:
                    continue
                if t0 is not None and t[lo] != t0:
                    yield from of_bucket(t0, k0, f0)
                    k0, f0 = k0[:0], f0[:0]
                t0 = int(t[lo])
                k0, f0 = np.r_[k0, k[lo:hi]], np.r_[f0, f[lo:hi]]
                done = int(np.searchsorted(k0, k0[-1]))  # the last bucket may go on
                yield from of_bucket(t0, k0[:done], f0[:done])
                k0, f0 = k0[done:], f0[done:]
        if t0 is not None:
            yield from of_bucket(t0, k0, f0)

    return (rows.repartition("t", "k").sortWithinPartitions("t", "k", "fp")
                .mapInArrow(run, "a bigint, b bigint"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """One row per document row: ``id, key, fp, component`` with the smallest
    id reachable through links (``component`` is null when every id of the
    component is null).

    Null and blank texts have fingerprint 0 and link like any other; rows
    repeated or sharing a text share a fingerprint and a component; an empty
    table gives an empty result; further columns are not read."""
    fps = materialize(fingerprints(docs, id_col, text_col, shingle, seed), "simhash")
    comps = connected_components(fingerprint_links(fps, radius), "a", "b")
    least = fps.groupBy("fp").agg(F.min("id").alias("least"))
    rooted = (least.join(comps, least.fp == comps.node, "left")
                   .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    root_id = rooted.groupBy("root").agg(F.min("least").alias("component"))
    by_fp = rooted.join(root_id, "root").select(F.col("fp").alias("of"), "component")
    return fps.join(by_fp, fps.fp == by_fp["of"]).select("id", "key", "fp", "component")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          shingle: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """The documents without near copies: of each component the row with the
    smallest id stays (ties: the smallest content key, then one of the equal
    rows).  Rows of a component whose ids are all null: one of them stays.
    All columns are returned as they are."""
    comps = materialize(simhash_components(docs, id_col, text_col, shingle, radius, seed), "simhash")
    # null ids form the component of their fingerprint's null-id rows
    best = (comps.groupBy("component", F.when(F.col("component").isNull(), F.col("fp")).alias("alone"))
                 .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("best")))
    row_id, row_key = fresh(docs, "_keep_id"), fresh(docs, "_keep_key")
    keep = best.select(F.col("best.id").alias(row_id), F.col("best.key").alias(row_key)).distinct()
    mine = fresh(docs, "_text_key")
    left = docs.withColumn(mine, text_key(text_col))
    kept = left.join(keep, left[id_col].eqNullSafe(keep[row_id]) & (left[mine] == keep[row_key]))
    return kept.dropDuplicates([row_id, row_key]).select(*[kept[c] for c in docs.columns])
