"""Winnowing, packing and SentencePiece encoding against plain versions."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from revlens.llm import winnow as W
from revlens.llm.packing import byte_bpe, pack, pieces_of
from revlens.llm.queries import QUERIES
from revlens.llm.spbpe import encode_decode, piece_model

SF = "/root/testdata/sf0.001"
ODD = [(4, "a  b \n c", "x"), (2, None, "y"), (2, None, "y"), (9, "", "z"), (None, "tail <|endoftext|> " * 3, "n"),
       (7, "日本語 😀 ﬁ ▁x\t<s> ", "q"), (5, "long words " * 4000, "l"), (4, "a  a", "x")]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id bigint, text string, offset string")


def slow_winnow(text, k=W.K, w=W.WINDOW):
    if not text:
        return []
    k = min(k, len(text))
    hs = []
    for i in range(len(text) - k + 1):
        h = 0
        for c in text[i:i + k]:
            h = (h * W.BASE + ord(c) + 1) & (1 << 64) - 1
        h = ((h ^ h >> 31) * 0xBF58476D1CE4E5B9) & (1 << 64) - 1
        hs.append((h ^ h >> 29) >> 32)
    w = min(w, len(hs))
    return sorted({min(range(i, i + w), key=lambda p: (hs[p], -p)) for i in range(len(hs) - w + 1)}), hs


def slow_edited(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for (i, t, *_), (_, nxt, *_) in zip(rows, rows[1:] + rows[:1]):
        t, nxt = t or "", nxt or ""
        cut = len(t) // 3
        edited = t[:len(t) - cut] + nxt[:cut]
        f, g, h = (W.winnow(x) for x in (t, edited, nxt))
        sets = [set(x[1].tolist()) for x in (f, g, h)]
        like = [1.0 if not sets[0] | s else len(sets[0] & s) / len(sets[0] | s) for s in sets[1:]]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), W.to_string(*f), W.to_string(*g), *like))
    return out


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abé日", max_size=200), st.integers(1, 9), st.integers(1, 12))
def test_winnow_matches_definition(text, k, w):
    pos, h = W.winnow(text, k, w)
    if not text:
        assert len(pos) == 0
        return
    want, hs = slow_winnow(text, k, w)
    assert pos.tolist() == want and h.tolist() == [hs[p] for p in want]


def test_op3_matches_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op3_winnowing"][0](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(slow_edited(rows))
    assert np.mean([r.near_edited for r in got]) > 0.4 > np.mean([r.near_next for r in got])


@pytest.mark.parametrize("keep", [None, 1, 0])
def test_op3_edge_rows(spark, keep):
    df = odd(spark)
    rows = ODD if keep is None else ODD[:keep]
    got = W.edited_fingerprints(df if keep is None else spark.createDataFrame(rows, df.schema)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(slow_edited(rows), key=key)


def check_pieces(rows, texts, end=1, full=2048):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.offset == 0 for r in rows)
    assert all(r.length & (r.length - 1) == 0 and r.length <= full and r.sequence_id >> 58 == r.bucket
               and 1 << r.bucket == r.length for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    want = {}
    for i, t in texts:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, end], "<u4")
        want.setdefault(i, []).extend((s, n, zlib.crc32(ids[s:s + n].tobytes()), len(ids))
                                      for s, n in pieces_of(len(ids), full))
    assert {k: sorted(v) for k, v in by.items()} == {k: sorted(v) for k, v in want.items()}


def test_op5_round_trip(spark):
    rows = QUERIES["op5_packing"][0](spark, SF).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check_pieces(rows, texts)


def test_op5_edge_rows(spark):
    check_pieces(pack(odd(spark), P.path("byte_bpe_50k.json")).collect(), [r[:2] for r in ODD])
    assert pack(odd(spark).limit(0), P.path("byte_bpe_50k.json")).count() == 0
    for n in range(1, 5000, 37):
        cut = pieces_of(n, 2048)
        assert [s for s, _ in cut] == list(np.cumsum([0] + [k for _, k in cut[:-1]])) and sum(k for _, k in cut) == n


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=60))
def test_byte_bpe_ids(text):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert byte_bpe(P.path("byte_bpe_50k.json")).encode(text, allowed_special="all") == \
        tok.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t▁aAeinst.é日"), st.characters(exclude_categories=["Cs"])),
               max_size=60))
def test_agenda_equals_library(text):
    m = piece_model(P.path("piece_bpe_32k.model"))
    ids = [i for s in m.segments(m.normalize(text)) for i in m.agenda(s)]
    assert ids == m.library.encode(text)


def check_sp(rows, texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    want = []
    for i, t in texts:
        ids = sp.encode(t or "") + [sp.eos_id()]
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(sp.decode(ids).encode()).hexdigest(), True))
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_op8_matches_library(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check_sp(QUERIES["op8_sentencepiece"][0](spark, SF).collect(), texts)


def test_op8_edge_rows(spark):
    check_sp(encode_decode(odd(spark), P.path("piece_bpe_32k.model")).collect(), [r[:2] for r in ODD])
    assert encode_decode(odd(spark).limit(0), P.path("piece_bpe_32k.model")).count() == 0


def test_segments_are_checked_as_one_text():
    """Ids that the library does not give are found among many segments, and
    all but odd ones cost one text for `CHECK_SEGMENTS` of them."""
    m = piece_model(P.path("piece_bpe_32k.model"))
    segments = [f"▁word{n}" for n in range(450)] + ["▁", "▁▁two", "lone", "▁日本語😀"]
    found = [m.agenda(s) for s in segments]
    given, library = [], m.library

    class Counted:
        def encode(self, texts, **kw):
            given.append(len(texts) if isinstance(texts, list) else 0)
            return library.encode(texts, **kw)

    m.library = Counted()
    try:
        assert m.differing(segments, found) == []
        assert sum(given) <= 3 + 3  # three texts, and the odd segments alone
        for k in (0, 333, 450, 452):
            wrong = [list(x) for x in found]
            wrong[k][-1] += 1
            assert m.differing(segments, wrong) == [segments[k]]
        swapped = [*found]
        swapped[7], swapped[8] = found[8], found[7]
        assert m.differing(segments, swapped) == segments[7:9]
    finally:
        m.library = library
