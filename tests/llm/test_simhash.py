"""SimHash: fingerprints, links and components against brute force."""

import numpy as np
import xxhash

from revlens.llm import simhash as S
from revlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def slow_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(ids, fps, radius=2):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [low.get(find(i)) for i in range(len(ids))]


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = [slow_fp(r.text) for r in rows]
    want = sorted(zip([r.doc_id for r in rows], (f"{f:016x}" for f in fps),
                      slow_components([r.doc_id for r in rows], fps)))
    got = sorted(map(tuple, QUERIES["op1_simhash"][0](spark, SF).collect()))
    assert got == want


def test_bit_sliced_pairs_large_buckets():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 3, dtype=np.uint64)
    fps = np.unique(np.concatenate([
        b ^ np.array([sum({1 << int(x): 0 for x in rng.integers(0, 19, 3)}) for _ in range(300)], np.uint64)
        for b in base]))
    bucket = (fps >> np.uint64(19)).astype(np.int64)
    for radius in (0, 1, 2, 3):
        i, j = S.bit_sliced_pairs(fps, bucket, list(range(19)), radius)
        want = {(a, b) for a in range(len(fps)) for b in range(a + 1, len(fps))
                if bucket[a] == bucket[b] and bin(int(fps[a] ^ fps[b])).count("1") <= radius}
        assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def test_links_of_random_neighbours(spark):
    rng = np.random.default_rng(7)
    fps = []
    for b in rng.integers(-(1 << 62), 1 << 62, 60):
        fps.append(int(b))
        for _ in range(4):
            x = int(b) & ((1 << 64) - 1)
            for p in rng.integers(0, 64, rng.integers(1, 4)):
                x ^= 1 << int(p)
            fps.append(x - (1 << 64) if x >= 1 << 63 else x)
    df = spark.createDataFrame([(f,) for f in fps] + [(None,)], "fp bigint")
    got = {tuple(sorted(r)) for r in S.fingerprint_links(df).collect()}
    u = sorted(set(fps))
    want = {(a, b) for i, a in enumerate(u) for b in u[i + 1:]
            if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2}
    assert got == want


def test_edge_rows(spark):
    docs = spark.createDataFrame(
        [(3, None, "x"), (1, "", "x"), (2, "  \n", "y"), (7, "a b", "z"), (7, "a b", "z"), (9, "A  B", "q"),
         (None, "other words entirely here", "n"), (5, "wide " * 5000, "l")],
        "doc_id bigint, text string, component string")
    got = {(r.id, r.component) for r in S.simhash_components(docs).collect()}
    assert got == {(3, 1), (1, 1), (2, 1), (7, 7), (9, 7), (None, None), (5, 5)}
    kept = S.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.component) for r in kept.collect()) == [(0, "n"), (1, "x"), (5, "l"), (7, "z")]
    assert S.dedup(docs.limit(0)).count() == 0
