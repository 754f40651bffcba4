"""Tokenizer alignment against a plain version by decoded bytes."""

import hashlib
from collections import Counter

import public_tokenizers as P
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from revlens.llm.alignment import align, align_documents, align_texts, alignments, tokens_of
from revlens.llm.queries import QUERIES

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [(4, "a  b \n c", 1), (2, None, 2), (2, None, 2), (9, "", 3), (None, "tail <|endoftext|> <s> </s> <unk> " * 3, 4),
       (7, "日本語 😀 ﬁ\t<0x0A> é́ \U0001f9ff‍𝒳", 5), (5, "long words, " * 4000, 6), (4, "a  a", 7), (8, "▁mark", 8),
       (10, " lead", 9), (11, "\x00\x01 nul", 10), (12, "   ", 11), (13, "trailing  ", 12), (14, "ＡＢ ½ ẞ\r\n", 13)]


def plain_ends(pieces):
    out, n = [], 0
    for p in pieces:
        n += len(p)
        out.append(n)
    return out


def plain_text(text, a, b):
    """(ids of A, ids of B, groups) by joined bytes alone, or None."""
    if not text:
        return None
    from revlens.llm.packing import byte_alphabet
    back = byte_alphabet()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
               else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    ends_a, ends_b = plain_ends(bytes_a), plain_ends(bytes_b)
    common = sorted(set(ends_a) & set(ends_b))
    groups, lo = [], 0
    for hi in common:
        groups.append(([i for i, e in zip(ids_a, ends_a) if lo < e <= hi], [i for i, e in zip(ids_b, ends_b) if lo < e <= hi]))
        lo = hi
    return ids_a, ids_b, groups


def plain(rows):
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    found = [(i, plain_text(t, a, b)) for i, t in rows]
    count = Counter((g[0][-1], g[1][-1]) for _, f in found if f for g in f[2])
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        pairs = [(g[0][-1], g[1][-1]) for g in f[2]]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[2])
        out.append((i, len(f[0]), len(f[1]), len(f[2]), len(pairs), sum(count[p] == most[p[1]] for p in pairs),
                    sum(count[p] for p in pairs), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    cols = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab  ,'s<>|▁é日😀́‍\n\t\x00½ﬁＡ1", max_size=40) | st.text(max_size=30))
def test_groups_match_decoded_bytes(text):
    """Whole texts as one segment, and cut into segments."""
    t = tokens_of(A, B)
    want = plain_text(text, t.a, t.b)
    n_a, n_b, n, groups, pairs = next(align_texts(t, [text]))
    mine = align(t, [" " + text])[0] if text else None
    assert (n == 0) == (want is None) == (mine is None)
    if want is not None:
        assert (n_a, n_b, n) == mine[:3] == (len(want[0]), len(want[1]), len(want[2]))
        assert mine[3] == groups == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want[2])
        assert mine[4] == pairs.tobytes() and pairs.tolist() == [x[-1] * t.n_b + y[-1] for x, y in want[2]]


def test_memory_is_cleared_and_long_segments_forgotten(monkeypatch):
    from revlens.llm import alignment as M
    t = tokens_of(A, B)
    t.known.clear()
    monkeypatch.setattr(M, "KNOWN_SEGMENTS", 3)
    texts = ["one two three", "x" * 200 + " four", "one two", "five six seven"]
    for x in texts:
        a = t.a.encode(" " + x, add_special_tokens=False).ids
        assert next(align_texts(t, [x]))[0] == len(a)
    assert all(len(s) <= M.KNOWN_CHARS for s in t.known) and len(t.known) <= 7


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string, pairs int").repartition(4)
    want = plain([r[:2] for r in ODD])
    # pairs counted in every task, by the join, and both
    for one_in in (10**9, 1, 50):
        assert got(align_documents(docs, A, B, hot_one_in=one_in)) == want


def test_empty_tables(spark):
    kind = "doc_id bigint, text string"
    assert align_documents(spark.createDataFrame([], kind), A, B).count() == 0
    none = spark.createDataFrame([(1, None), (2, "")], kind)
    assert got(align_documents(none, A, B)) == plain([(1, None), (2, "")])


def test_groups_column(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id bigint, text string")
    row = alignments(docs, A, B, with_groups=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256 and row.n_groups == 2


def test_query_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op13_alignment"][0](spark, "/root/testdata/sf0.001")) == plain(rows)
