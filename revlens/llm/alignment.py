"""Alignment of two tokenizers' tokens over the same texts.

Both libraries give each token its character span; where a token ends before
the next one begins, that span is a coarse cut, moved to bytes through the
UTF-8 widths of the text's characters.  Tokens that share a character with
the next one (pieces of a multibyte character, byte-fallback tokens) are
refined by their decoded bytes from the last coarse cut on.  Cuts that both
tokenizers have part a text into groups; the tokens that end there are
linked.

Neither tokenizer has a token across a lone space between two other
characters: the first one's pattern begins a word there, and no piece of the
second one holds a space mark behind another character (checked).  So texts
fall into segments that are aligned for themselves, and a worker remembers
those it has met.

A pair of ids counts in all its links of the corpus.  Texts are encoded
once; each row keeps its different pairs and how often it has them.  Pairs
that hold at least one in `HOT_ONE_IN` of all links are at most as many, so
their counts go to every task; the rows of all other pairs, none of them
hot, meet their counts in a shuffled join.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import texts_of
from .packing import byte_alphabet

SPACE = "▁"
#: Pairs with at least one in so many links are counted in every task.
HOT_ONE_IN = 200_000
#: Segments remembered per worker process, and the longest one remembered.
KNOWN_SEGMENTS = 500_000
KNOWN_CHARS = 48
#: Segments that are encoded together, and texts that are read together.
BATCH_SEGMENTS = 10_000
#: Segments in one encoded text.
RUN = 500
BATCH_TEXTS = 200
#: A lone space between two other characters (none of them white space).
_CUT = re.compile(r"(?<=\S)(?= \S)")


class Tokens:
    """Entries of both vocabularies: bytes, their lengths, and the texts that
    stand for an id inside a group, at its end, or at the end of a segment."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        back, special = byte_alphabet(), {i for i in self.a.get_added_tokens_decoder()}
        self.n_a, self.n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        pieces = [self.a.id_to_token(i) for i in range(self.n_a)]
        self.bytes_a = [p.encode() if i in special else bytes(back[c] for c in p) for i, p in enumerate(pieces)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(self.b.id_to_piece(list(range(self.n_b))))]
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # a space mark inside a piece would join segments
        if any(SPACE in p.lstrip(SPACE) for i, p in enumerate(self.b.id_to_piece(list(range(self.n_b))))
               if not self.b.is_byte(i)):
            raise ValueError("pieces with inner spaces are not supported")
        self.known: dict[str, tuple | None] = {}
        self.written = np.array([f"{i}{sep}" for n, seps in ((self.n_a, ",|"), (self.n_b, ",;\n"))
                                 for sep in seps for i in range(n)], object)


@lru_cache(maxsize=1)
def tokens_of(byte_path: str, piece_path: str) -> Tokens:
    return Tokens(byte_path, piece_path)


def byte_ends(starts: np.ndarray, ends: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """End of each token in bytes: from its character span (``at`` gives the
    byte place of a character) if the next token begins behind it, else by
    the decoded bytes since the last such token."""
    n = len(ends)
    coarse = np.empty(n, bool)
    coarse[:-1] = ends[:-1] <= starts[1:]
    coarse[-1:] = True
    # tokens without a character of their own end inside or before one
    coarse &= ends > np.concatenate([[-1], np.maximum.accumulate(ends)[:-1]])
    here = at[ends]
    if coarse.all():
        return here
    place = np.arange(n)
    last = np.maximum.accumulate(np.where(coarse, place, -1))
    run = np.cumsum(lengths)
    base = np.where(last >= 0, here[last] - run[last], 0)
    return run + base


def _numbers(lists) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64)


def align(t: Tokens, segments: list[str]) -> list[tuple | None]:
    """Per segment (a text that begins with a space and holds more): tokens
    of A and B, groups, the groups' text ``a1,a2|b1;a3|b2,b3`` and the codes
    of the linked pairs as bytes; None if the tokens do not spell it out.

    Segments with a lone space before and no white space behind are encoded
    many at a time, as one text."""
    plain = [k for k, x in enumerate(segments) if len(x) > 1 and not x[1].isspace() and not x[-1].isspace()]
    rest = set(range(len(segments))).difference(plain)
    out: list[tuple | None] = [None] * len(segments)
    runs = [plain[lo:lo + RUN] for lo in range(0, len(plain), RUN)] + [[k] for k in sorted(rest)]
    while runs:
        # a run that is not spelled out is taken apart
        runs = [[k] for run in _align_runs(t, segments, runs, out) if len(run) > 1 for k in run]
    return out


def _align_runs(t: Tokens, segments: list[str], runs: list[list[int]], out: list) -> list[list[int]]:
    """Align runs of segments, laid end to end; returns the runs that the
    tokens do not spell out."""
    texts = ["".join(segments[k] for k in run) for run in runs]
    got_a = t.a.encode_batch(texts, add_special_tokens=False)
    got_b = t.b.encode([x[1:] for x in texts], return_type="offset_mapping", num_threads=1)
    ids_a, ids_b = [e.ids for e in got_a], [e["ids"] for e in got_b]
    spell_a, spell_b = t.bytes_a.__getitem__, t.bytes_b.__getitem__
    raws = [x.encode() for x in texts]
    good, bad = [], []
    for i, raw in enumerate(raws):
        fits = b"".join(map(spell_a, ids_a[i])) == raw and b"".join(map(spell_b, ids_b[i])) == raw
        (good if fits else bad).append(i)
    bad = [runs[i] for i in bad]
    if not good:
        return bad
    own = [k for i in good for k in runs[i]]
    stop = np.cumsum([len(segments[k].encode()) for k in own])
    count_a, count_b = (np.array([len(ids[i]) for i in good]) for ids in (ids_a, ids_b))
    chars = np.array([len(texts[i]) for i in good])
    begin = np.cumsum(chars) - chars
    raw = b"".join(raws[i] for i in good)
    if len(raw) == chars.sum():
        at = np.arange(len(raw) + 1)
    else:  # bytes that are no continuation begin a character
        at = np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))
    a, b = _numbers(ids_a[i] for i in good), _numbers(ids_b[i] for i in good)
    span_a = _numbers(chain.from_iterable(got_a[i].offsets for i in good)).reshape(-1, 2)
    span_a += np.repeat(begin, count_a)[:, None]
    # the second library's spans are those of the text without the space
    span_b = _numbers(chain.from_iterable(got_b[i]["offsets"] for i in good)).reshape(-1, 2)
    span_b += np.repeat(begin, count_b)[:, None] + 1
    span_b[np.cumsum(count_b) - count_b, 0] = begin
    ends_a = byte_ends(span_a[:, 0], span_a[:, 1], t.len_a[a], at)
    ends_b = byte_ends(span_b[:, 0], span_b[:, 1], t.len_b[b], at)
    n_a, n_b = (np.diff(np.searchsorted(e, stop, side="right"), prepend=0) for e in (ends_a, ends_b))

    # both cut at the end of each segment, so the last place is common
    place = np.searchsorted(ends_a, ends_b)
    both = ends_a[place] == ends_b
    cut_b, cut_a = np.flatnonzero(both), place[both]
    pairs = a[cut_a] * t.n_b + b[cut_b]
    upto = np.searchsorted(ends_b[cut_b], stop, side="right")
    groups = np.diff(upto, prepend=0)

    size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    in_group = np.arange(len(cut_a))
    group_a, group_b = np.repeat(in_group, size_a), np.repeat(in_group, size_b)
    a[cut_a] += t.n_a
    b += 2 * t.n_a
    b[cut_b] += t.n_b
    b[cut_b[upto - 1]] += t.n_b
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + (np.cumsum(size_b) - size_b)[group_a]] = a
    order[np.arange(len(b)) + np.cumsum(size_a)[group_b]] = b
    written = "".join(t.written[order].tolist()).split("\n")
    flat, hi = pairs.tobytes(), (upto * 8).tolist()
    for k, *row, lo, end in zip(own, n_a.tolist(), n_b.tolist(), groups.tolist(), written, [0, *hi], hi):
        out[k] = (*row, flat[lo:end])
    return bad


def _learn(t: Tokens, segments: list[str]) -> None:
    for lo in range(0, len(segments), BATCH_SEGMENTS):
        some = segments[lo:lo + BATCH_SEGMENTS]
        t.known.update(zip(some, align(t, some)))


def align_texts(t: Tokens, texts: list[str]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
    """Per text: tokens of A and of B, groups, the groups' text and the codes
    of the linked pairs; zeros and empties if there are no tokens."""
    cut = [_CUT.split(" " + x) if x else [] for x in texts]
    if len(t.known) > KNOWN_SEGMENTS:
        t.known.clear()
    new = set().union(*cut).difference(t.known)
    _learn(t, list(new))
    for segments in cut:
        parts = list(map(t.known.__getitem__, segments))
        if not parts or None in parts:
            yield 0, 0, 0, "", np.empty(0, np.int64)
            continue
        n_a, n_b, n, groups, pairs = zip(*parts)
        yield sum(n_a), sum(n_b), sum(n), ";".join(groups), np.frombuffer(b"".join(pairs), np.int64)
    for s in new:  # very long segments are not worth remembering
        if len(s) > KNOWN_CHARS:
            del t.known[s]


def _lists(arrays: list[np.ndarray], kind) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def alignments(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
               with_groups: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups,
    groups_sha256, pairs, times`` (and ``groups`` ``with_groups``).

    Tokenizer A encodes space + text, B the text; a pair is the code
    ``a * size of B + b`` of two linked ids, ``times`` how many links of the
    text hold it.  Null and empty texts, and those that the tokens of either
    do not spell out, have no tokens: zeros, empty lists and strings."""
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokens_of(byte_path, piece_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_TEXTS):
                some = batch.slice(lo, BATCH_TEXTS)
                rows, pairs, times, groups = [], [], [], []
                for n_a, n_b, n, text, codes in align_texts(t, texts_of(some.column("text"))):
                    sha = hashlib.sha256(text.encode()).hexdigest() if n else ""
                    rows.append((n_a, n_b, n, sha))
                    code, count = np.unique(codes, return_counts=True)
                    pairs.append(code)
                    times.append(count)
                    if with_groups:
                        groups.append(text)
                n_a, n_b, n, sha = zip(*rows) if rows else ((), (), (), ())
                arrays = [some.column("doc_id"), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()),
                          pa.array(n, pa.int64()), pa.array(sha, pa.string()), _lists(pairs, pa.int64()),
                          _lists(times, pa.int64())]
                names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"]
                if with_groups:
                    arrays.append(pa.array(groups, pa.string()))
                    names.append("groups")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = (f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
              "pairs array<bigint>, times array<bigint>" + ", groups string" * with_groups)
    return src.mapInArrow(run, schema)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs and times of some rows -> times per pair of the batch."""
    for b in batches:
        code = b.column("pairs").flatten().to_numpy(zero_copy_only=False)
        times = b.column("times").flatten().to_numpy(zero_copy_only=False)
        pair, at = np.unique(code, return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, at, times)
        yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(total)], names=["pair", "n"])


def pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """``pair, n, best``: links of a pair in all rows, and whether no pair
    with the same id of B has more (a B id has at most as many pairs as A
    has ids)."""
    pairs = materialize(rows.select("pairs", "times").mapInArrow(_sums, "pair bigint, n bigint")
                        .groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.pmod("pair", F.lit(n_b))
    most = pairs.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return pairs.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
                    hot_one_in: int = HOT_ONE_IN) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups_sha256`` (see `alignments`).

    ``n_best`` counts the links whose pair is the commonest of its B id in
    the corpus (ties included), ``count_sum`` adds up the corpus counts of
    the links' pairs.  Repeated rows count each and have a row each; an
    empty table gives no rows."""
    spark = docs.sparkSession
    rows = alignments(docs, byte_path, piece_path, id_col, text_col)
    # written once, so a row's number stays
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "alignments")
    n_b = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    counts = materialize(pair_counts(rows, n_b), "pair-counts")
    total = counts.select(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot_pairs = counts.where(F.col("n") * hot_one_in >= total).orderBy("pair").toArrow()
    hot = spark.sparkContext.broadcast(tuple(hot_pairs[c].to_numpy() for c in ("pair", "n", "best")))

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = hot.value
        for b in batches:
            lists, counted = b.column("pairs"), b.column("times")
            code = lists.flatten().to_numpy(zero_copy_only=False)
            times = counted.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            at = np.searchsorted(pair, code)
            at[at == len(pair)] = 0
            is_hot = pair[at] == code if len(pair) else np.zeros(len(code), bool)
            sums, bests = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            if is_hot.any():
                np.add.at(sums, owner[is_hot], times[is_hot] * n[at[is_hot]])
                np.add.at(bests, owner[is_hot], times[is_hot] * best[at[is_hot]])
            rest = ~is_hot
            ends = np.searchsorted(owner[rest], np.arange(b.num_rows + 1))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(sums), pa.array(bests),
                 pa.ListArray.from_arrays(offsets, pa.array(code[rest], pa.int64())),
                 pa.ListArray.from_arrays(offsets, pa.array(times[rest], pa.int64()))],
                names=["row", "count_sum", "n_best", "pairs", "times"])

    part = materialize(rows.select("row", "pairs", "times").mapInArrow(
        known, "row bigint, count_sum bigint, n_best bigint, pairs array<bigint>, times array<bigint>"), "hot-sums")
    rest = part.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    rare = (rest.join(counts.where(F.col("n") * hot_one_in < total), rest["pairs"] == F.col("pair"))
                .select("row", (F.col("times") * F.col("n")).alias("count_sum"),
                        (F.col("times") * F.col("best").cast("bigint")).alias("n_best")))
    sums = (part.select("row", "count_sum", "n_best").unionByName(rare).groupBy("row")
                .agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best")))
    return (rows.drop("pairs", "times").join(sums, "row")
                .select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum",
                        "groups_sha256"))
