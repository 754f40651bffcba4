"""Embedding near-duplicates against brute force."""

import numpy as np

from revlens.llm import embeddup as E
from revlens.llm.queries import QUERIES


def slow(rows, t=0.95):
    ok, out = [], {}
    for k, (_, v) in enumerate(rows):
        good = v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        ok.append(np.array(v, float) / np.linalg.norm(np.array(v, float) / max(map(abs, v))) / max(map(abs, v))
                  if good else None)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    n = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] is not None and ok[j] is not None and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= t:
                n[i] += 1
                n[j] += 1
                root[find(i)] = find(j)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            out[find(i)] = min(d, out.get(find(i), d))
    return sorted(((d, n[i], out.get(find(i)), d == out.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def test_query_and_planted_copies(spark, tmp_path):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 64))
    rows = [(i, (base[i % 40] + rng.normal(size=64) * rng.choice([0.0, 0.12, 0.3, 3.0])).astype("f4").tolist())
            for i in range(400)]
    spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<float>, label int") \
        .write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op6_embeddings"][0](spark, str(tmp_path)).collect()
    want = slow(rows)
    assert sorted(map(tuple, got), key=str) == want and any(r[1] for r in want)
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, QUERIES["op6_embeddings"][0](spark, sf).collect()), key=str) == slow(rows)


def test_tiles_and_bounds(monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 10)) * np.linspace(4, 0.2, 10)
    x = np.vstack([x, x[:150] + rng.normal(size=(150, 10)) * 0.1])
    u = E.unit(x)
    basis = np.linalg.qr(rng.normal(size=(10, 10)))[0]
    for t in (0.5, 0.9, 0.99):
        i, j = E.compare(u, u, basis, t, True)
        want = {(a, b) for a in range(450) for b in range(a + 1, 450) if u[a] @ u[b] >= t}
        assert set(zip(i.tolist(), j.tolist())) == want
        i, j = E.compare(u[:200], u[200:], basis, t, False)
        assert set(zip(i.tolist(), (j + 200).tolist())) == {(a, b) for a, b in want if a < 200 <= b}
        keep = E.forest(i, j)
        assert len(keep) <= len(i)


def test_edge_rows_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(E, "TILE_ROWS", 7)
    rng = np.random.default_rng(8)
    rows = [(i, (rng.normal(size=6) * [5, 3, 1, 1, 1, 1]).tolist()) for i in range(120)]
    rows += [(200 + i, [1.0, 2.0, 3.0, 0.0, 0.0, 0.0]) for i in range(30)]
    rows += [(300, None), (301, []), (302, [0.0] * 6), (303, [0.0] * 6), (304, [1.0, None, 0.0, 0.0]),
             (305, [float("nan")] * 6), (306, [float("inf"), 1.0]), (307, [1e300, 2e300, 3e300, 0.0, 0.0, 0.0]),
             (308, [1e-200, 2e-200, 3e-200, 0.0, 0.0, 0.0]), (309, [1.0, 2.0, 3.0]), (310, [2.0, 4.0, 6.0]),
             (5, rows[5][1]), (None, [1.0, 2.0, 3.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, component_id int")
    got = [tuple(r) for r in E.near_duplicates(df, threshold=0.9).collect()]
    assert sorted(got, key=str) == slow(rows, 0.9)
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_tiles_move_by_block_not_by_neighbour(spark, monkeypatch):
    monkeypatch.setattr(E, "TILE_ROWS", 8)
    moved, unit = spark.sparkContext.accumulator(0), E.unit

    def counted(x):
        moved.add(len(x))
        return unit(x)

    monkeypatch.setattr(E, "unit", counted)
    rng = np.random.default_rng(5)
    rows = [(i, (np.ones(6) + rng.normal(size=6) * 0.01).tolist()) for i in range(240)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = [tuple(r) for r in E.near_duplicates(df).collect()]
    assert sorted(got) == [(i, 239, 0, i == 0) for i in range(240)]
    # moments and cells take each vector three times; the rest is what the tiles of a cell cost their block pairs
    assert moved.value <= (3 + E.BLOCKS) * 240


def test_block_pairs_take_turns(spark, monkeypatch):
    monkeypatch.setattr(E, "TILE_ROWS", 5)
    monkeypatch.setattr(E, "BLOCK_VALUES", 60)
    monkeypatch.setattr(E, "TURN_BYTES", 1)
    names, write = [], E.materialize
    monkeypatch.setattr(E, "materialize", lambda df, name, **k: names.append(name) or write(df, name, **k))
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=6) * [5, 2, 1, 1, 1, 1]).astype("f4").tolist()) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = [tuple(r) for r in E.near_duplicates(df, threshold=0.9).collect()]
    assert sorted(got, key=str) == slow(rows, 0.9)
    assert names.count("links") > 3
