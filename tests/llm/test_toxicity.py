"""Toxicity: restoration, held-out accuracy, edge rows."""

import zlib
from itertools import product

import pytest

from revlens.llm import toxicity as T
from revlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def chars(spark):
    words = "you are an idiot and a stupid moron what the loser trash of it is on in to as at hello world"
    df = spark.createDataFrame([(" ".join([words] * 20),)], "text string")
    return T.CharModel(T.char_trigrams(df))


@pytest.mark.parametrize("written,want", [
    ("1d10t", "idiot"), ("st*pid", "stupid"), ("iiidioooot", "idiot"), ("m0r0n", "moron"), ("l.o.s.e.r", "loser"),
    ("tr@$h", "trash"), ("i d i o t", "idiot"), ("hello", "hello")])
def test_restore(chars, written, want):
    assert T.restore(written, chars) == want
    if written != "hello" and " " not in written:
        assert T.suspicious(written)


def test_words_of_text(chars):
    got = T.restored_words("You i d i o t, 5TUP1D!! call +1 (555) 010-9999 or me@mail.example.com x=1a2", chars, {})
    assert {"idiot", "stupid"} <= got and not T.suspicious("me@mail.example.com") and not T.suspicious("010-9999")


def test_viterbi_is_the_cheapest_path(chars):
    def cost(pieces, extra):
        s, c = "  ", extra
        for ch in "".join(pieces) + " ":
            c += chars.cost(s + T.known(ch))
            s = T.step(s, T.known(ch))
        return c
    for written in ("1d10t", "a1!b", "s.t.u", "aa1"):
        paths = list(product(*T.lattice(written)))
        best = min(cost([o for o, _ in p], sum(x for _, x in p)) for p in paths)
        got = T.restore(written, chars)
        assert any("".join(o for o, _ in p).strip() == got
                   and cost([o for o, _ in p], sum(x for _, x in p)) <= best + 1e-9 for p in paths)


def test_query_held_out(spark):
    got = QUERIES["op10_toxicity"][0](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.5) for r in got)
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r.predicted, label[r.doc_id]) for r in got if r.held_out and r.doc_id in label]
    assert sum(p == y for p, y in held) / len(held) > 0.9


def test_features_count_documents(spark):
    """Against plain counts; ties go by the feature, also at the cut."""
    import math
    import random
    rng = random.Random(3)
    vocab = ["idiot", "idiots", "idiotic", "stupid", "fine", "finer", "day", "to", "days", "moron"]
    rows = []
    for i in range(120):
        y = int(i % 4 == 0)
        words = rng.sample(vocab[4:], 3) + (rng.sample(vocab[:4], rng.randrange(1, 4)) if y else rng.sample(vocab, 1))
        rows.append((y, sorted(set(words))))
    n, pos = len(rows), sum(y for y, _ in rows)
    count: dict = {}
    for y, words in rows:
        for f in {f for w in words for f in T.word_features(w)}:
            c = count.setdefault(f, [0, 0])
            c[0] += y
            c[1] += 1
    def lift(c):
        return math.log((c[0] + .5) / (pos + 1)) - math.log((c[1] - c[0] + .5) / (n - pos + 1))
    want = sorted((f for f, c in count.items() if c[0] >= T.MIN_DOCS and lift(c) > 1),
                  key=lambda f: (-round(lift(count[f]) * math.sqrt(count[f][0]), 9), f))
    lab = spark.createDataFrame(rows, "y int, words array<string>")
    assert len(want) > 5
    for k in (1, 4, 100):
        assert T.strongest_features(lab, n, pos, k) == want[:k]


def test_edge_rows(spark):
    docs = spark.createDataFrame([(i, f"you {('stupid', 'idiot')[i // 2 % 2]} man" if i % 2 else "you fine man", 7) for i in range(40)]
                                 + [(100, None, 1), (100, None, 1), (101, "", 1), (None, "1d10t", 1),
                                    (102, "s t u p i d", 1), (103, "word " * 20000, 1)],
                                 "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(i, i % 2, "q") for i in range(40)] + [(None, 1, "q"), (3, None, "q")],
                                   "doc_id bigint, toxic int, text string")
    got = T.score_documents(docs, labels).collect()
    assert len(got) == 46
    by = {r.doc_id: r for r in got}
    assert all(by[i].predicted == i % 2 for i in range(40))
    assert by[None].predicted == 1 and not by[None].held_out and by[102].predicted == 1
    assert by[100].score == by[101].score < 0.5 and by[103].predicted == 0
    kept = T.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 24
    none = T.score_documents(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert T.score_documents(docs.limit(0), labels).count() == 0


def test_letters_with_signs_behind_them_are_set_apart(monkeypatch):
    """The gate sees the letters as ``set_apart`` strips them."""
    monkeypatch.setattr(T, "restore", lambda spelled, model: spelled.replace(T.EDGE, ""))
    memo = {t: () for t in "i. d. o. t. you are".split()}
    assert "idiot" in T.restored_words("you are i. d. i. o. t.", None, memo)
    assert T.set_apart("a, a, a,".split(), None) == set()
