"""Collocations against a plain version."""

import random
import re
from collections import Counter

import pytest

from revlens.llm import collocations as C
from revlens.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, top, min_count=10, cover=50):
    counts = {}
    for lang, text in rows:
        c = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3):
                c.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        found = []
        for p, a in c.items():
            if len(p) == 1 or a < min_count:
                continue
            if len(p) == 2 and any(len(q) == 3 and b >= min_count and 100 * b >= cover * a and p in (q[:2], q[1:])
                                   for q, b in c.items()):
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((lang, " ".join(p), a, c[p[:k]], c[p[k:]], n, score))
        found.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(found[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, rows=240):
    rnd = random.Random(seed)
    vocab = ["the", "The", "of", "new", "york", "city", "x y", "été", "日本", "a\x00b"] + [f"w{i}" for i in range(25)]
    fixed = ["new york city", "of the", "york city of", "w1 w2 w3", "w1 w2 w4"]
    out = []
    for i in range(rows):
        parts = [rnd.choice(fixed) if rnd.random() < 0.4 else rnd.choice(vocab) for _ in range(rnd.randrange(60))]
        text = "".join(p + rnd.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b"]) for p in parts)
        out.append((rnd.choice(["en", "en", "de", None]), text))
    return out + [(None, None), ("en", ""), ("fr", "..."), ("en", out[0][1]), ("en", out[0][1]), ("es", "one two")]


@pytest.mark.parametrize("top, width", [(5, 1), (40, 2), (2000, 2)])
def test_whole_results(spark, top, width):
    """Small tops settle after several rounds of growth, large ones in one."""
    rows = corpus(top)
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "lang string, text string, phrase string").repartition(3)
    assert got(C.collocations(docs, top=top, width=width)) == plain(rows, top)


def test_several_rounds_and_drops(spark):
    """The best pairs of words are all covered by longer phrases, so the
    first frontier settles nothing."""
    text = ". ".join(f"a{i} b{i} c{i}" for i in range(12)) + ". " + ". ".join(f"p{i % 3} q{i % 4}" for i in range(12))
    rows = [("en", text)] * 12
    docs = spark.createDataFrame(rows, "lang string, text string")
    for top in (1, 3, 13, 30):
        assert got(C.collocations(docs, top=top, width=1)) == plain(rows, top)


def test_long_text_in_small_chunks(spark):
    rnd = random.Random(4)
    long = " ".join(rnd.choice(["aa", "bb", "cc", "dd,", "ee."]) for _ in range(4000))
    rows = [("en", long), ("de", long[:900]), ("en", "aa bb cc")]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    for chunk, held in ((64, 128), (1000, 1500), (C.CHUNK, C.HELD)):
        assert got(C.collocations(docs, top=50, chunk=chunk, held=held)) == plain(rows, 50)


def test_crowded_bitmap_loses_nothing(spark, monkeypatch):
    rows = corpus(9, 120)
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(C, "_bitmap", lambda flagged: C.np.full(1 << (C.SLOT_BITS - 1), 0x77, C.np.uint8))
    assert got(C.collocations(docs, top=20)) == plain(rows, 20)


def test_bitmap_slots_agree(spark):
    words = ["of the", "été 日本", ""]
    import pyarrow as pa
    df = spark.createDataFrame([("und", w) for w in words], "lang string, phrase string")
    assert [r[0] for r in df.select(C.slot_of(df.lang, df.phrase)).collect()] == C._slots("und", pa.array(words)).tolist()


def test_products_past_64_bits(spark):
    df = spark.createDataFrame([(4 * 10**12, 9 * 10**12, 5 * 10**12)], "a bigint, l bigint, r bigint")
    assert df.select(C._floor_score("a", "l", "r")).first()[0] == 1000000 * 16 * 10**24 // (45 * 10**24)


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_query_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "text").collect()]
    assert got(QUERIES["op12_collocations"][0](spark, "/root/testdata/sf0.001")) == plain(rows, 2000)
