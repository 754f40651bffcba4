"""Exact duplicates against a plain version."""

import hashlib

from pyspark.sql import functions as F

from revlens.llm.exactdup import content_digest, dedup, duplicates
from revlens.llm.queries import QUERIES

ROWS = [(1, "a", "x"), (5, "a", "y"), (3, "a", "x"), (7, None, "z"), (2, "", "z"), (9, "long words " * 5000, "l"),
        (10, "long words " * 5000, "l"), (11, "A", "x"), (12, "a ", "x"), (None, "a", "n"), (None, "only null", "n"),
        (6, "twice", "p"), (6, "twice", "p"), (6, "twice", "q"), (4, "twice", "q"), (13, "é", "u"), (14, "é", "u")]
KIND = "doc_id bigint, text string, digest string"


def plain(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t, *_ in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    cols = ["id", "keep_id", "group_size", "kept", F.lower(F.hex("digest"))]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, KIND).repartition(5)
    assert got(duplicates(docs)) == plain(ROWS)


def test_hot_texts_and_salts(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 40}" if i % 3 == 1 else f"own {i}", "x") for i in range(900)]
    docs = spark.createDataFrame(rows, KIND).repartition(7)
    # every digest of two rows or more is hot, then only the third of all rows
    for one_in in (450, 10):
        assert got(duplicates(docs, salts=4, hot_one_in=one_in)) == plain(rows)


def test_different_texts_under_one_digest(spark):
    docs = spark.createDataFrame(ROWS, KIND)
    weak = duplicates(docs, salts=3, hot_one_in=4, digest=lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 3), 2, "0")))
    want = [r[:4] for r in plain(ROWS)]
    assert sorted((tuple(r) for r in weak.select("id", "keep_id", "group_size", "kept").collect()), key=str) == \
        sorted(want, key=str)


def test_empty_table_and_dedup(spark):
    docs = spark.createDataFrame([], KIND)
    assert duplicates(docs).count() == 0 and dedup(docs).count() == 0
    kept = dedup(spark.createDataFrame(ROWS, KIND).repartition(4)).collect()
    assert kept[0].asDict().keys() == {"doc_id", "text", "digest"}
    want = {(keep, t) for _, keep, _, _, t in plain(ROWS)}
    assert sorted((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in kept if r.doc_id) == \
        sorted(w for w in want if w[0]) and len(kept) == len(want)


def test_plan_has_no_python(spark):
    plan = duplicates(spark.createDataFrame(ROWS, KIND))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan


def test_query_counts_every_document(spark):
    df = QUERIES["op11_exact_dedup"][0](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert df.count() == docs.count()
    assert df.where("kept").count() == docs.select(content_digest(F.col("text"))).distinct().count()
