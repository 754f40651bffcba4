"""SentencePiece merge-type (BPE) encoding and decoding.

The encoder keeps an agenda of adjacent symbol pairs ordered by the score of
their merged piece (leftmost first on ties) and merges the best until none
is left; symbols outside the vocabulary fall back to bytes.  Text is cut
before each run of spaces and at characters that no longer piece contains:
no piece can span such a cut, so the segments' encodings are the text's
encoding, and repeated segments are encoded once per task.  Every segment
the agenda encodes is checked against the sentencepiece library, a batch of
segments at a time: as one text, and one by one if that differs.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of

SPACE = "▁"
#: Segments remembered per worker process, and the longest one remembered.
CACHE_SEGMENTS = 500_000
CACHE_CHARS = 48
#: Segments that the library encodes as one text.
CHECK_SEGMENTS = 200
#: Up to so many symbols the agenda is a plain list, beyond it a heap.
LIST_SYMBOLS = 24
#: Punctuation that may be cut off the word before it.
PUNCTUATION = ",.;:!?)\"|#%&$*"


class PieceModel:
    """Vocabulary of a merge-type model and its agenda encoder."""

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.end_id, self.unk_id = sp.eos_id(), sp.unk_id()
        self.byte_id, self.piece_id, self.score = {}, {}, {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
            elif sp.is_unused(i):
                raise ValueError("models with unused pieces are not supported")
            elif not sp.is_control(i) and not sp.is_unknown(i):
                self.piece_id[piece], self.score[piece] = i, sp.get_score(i)
        if any(SPACE in p.lstrip(SPACE) for p in self.piece_id):
            raise ValueError("pieces with inner spaces are not supported")
        joined = {c for p in self.piece_id if len(p) > 1 for c in p}
        after_word = {p[i] for p in self.piece_id for i in range(1, len(p)) if re.match(r"\w", p[i - 1])}
        self.alone = "".join(c for c in "\n\t\r" if c not in joined)
        # a segment: spaces and what follows them, up to the next space, to a
        # lone character, or to punctuation that no piece has behind a word
        cut = re.escape("".join(c for c in PUNCTUATION if c not in after_word))
        keep = f"[^{SPACE}{self.alone}{cut}]++" + (f"|(?<!\\w)[{cut}]" if cut else "")
        lone = f"|[{self.alone}]" if self.alone else ""
        self.segments = re.compile(f"{SPACE}+(?:{keep})*+|[^{SPACE}{self.alone}](?:{keep})*+{lone}").findall
        self.text = [str(i) for i in range(n)]
        # ids of known segments, and as text (tuples, which garbage collection leaves alone)
        self.known: dict[str, tuple[int, ...]] = {}
        self.known_text: dict[str, str] = {}
        self.wrong: set[str] = set()

    def normalize(self, text: str) -> str:
        """Spaces become the space mark; one is put before a text that isn't
        empty.  (Checked with the library's own normaliser segment by segment.)"""
        return SPACE + text.replace(" ", SPACE) if text else ""

    def agenda(self, segment: str) -> list[int]:
        """Ids of one segment, by score-ordered merges of adjacent symbols."""
        if len(segment) <= LIST_SYMBOLS:
            return self._ids(self._short(list(segment)))
        score, symbols, n = self.score, list(segment), len(segment)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        todo: list = []

        def offer(left: int, right: int) -> None:
            merged = symbols[left] + symbols[right]
            s = score.get(merged)
            if s is not None:
                heapq.heappush(todo, (-s, left, right, merged))

        for i in range(n - 1):
            offer(i, i + 1)
        while todo:
            _, left, right, merged = heapq.heappop(todo)
            # stale if either symbol has been merged since
            if not symbols[left] or not symbols[right] or after[left] != right \
                    or symbols[left] + symbols[right] != merged:
                continue
            symbols[left], symbols[right] = merged, ""
            nxt = after[left] = after[right]
            if nxt >= 0:
                before[nxt] = left
                offer(left, nxt)
            if before[left] >= 0:
                offer(before[left], left)
        return self._ids([s for s in symbols if s])

    def _short(self, symbols: list[str]) -> list[str]:
        """Merges of a few symbols; the agenda holds the score of each pair."""
        score, none = self.score, float("-inf")
        todo = [score.get(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while todo:
            best = max(todo)
            if best == none:
                break
            i = todo.index(best)  # the leftmost
            symbols[i] += symbols.pop(i + 1)
            todo.pop(i)
            if i < len(todo):
                todo[i] = score.get(symbols[i] + symbols[i + 1], none)
            if i:
                todo[i - 1] = score.get(symbols[i - 1] + symbols[i], none)
        return symbols

    def _ids(self, symbols: list[str]) -> list[int]:
        known, raw = self.piece_id, self.byte_id
        try:
            return [known[s] for s in symbols]
        except KeyError:
            ids = []
        for s in symbols:
            i = known.get(s)
            if i is not None:
                ids.append(i)
            elif raw:
                ids.extend(raw[b] for b in s.encode("utf-8"))
            elif not ids or ids[-1] != self.unk_id:
                ids.append(self.unk_id)
        return ids

    def learn(self, segments: set[str]) -> None:
        """Encode new segments and check them against the library."""
        fresh, text = list(segments), self.text
        found = [self.agenda(s) for s in fresh]
        for s, ids in zip(fresh, found):
            self.known[s] = tuple(ids)
            self.known_text[s] = " ".join([text[i] for i in ids])
        self.wrong.update(self.differing(fresh, found))

    def differing(self, segments: list[str], found: list[list[int]]) -> list[str]:
        """Segments whose ids the library does not give.  Segments that begin
        with one space mark are encoded as one text, which must have their ids
        one after the other; all others, and those of a text that differs, are
        encoded one by one."""
        plain = [k for k, s in enumerate(segments) if s[0] == SPACE and len(s) > 1 and s[1] != SPACE]
        rest = set(range(len(segments))).difference(plain)
        parts = [plain[k:k + CHECK_SEGMENTS] for k in range(0, len(plain), CHECK_SEGMENTS)]
        texts = ["".join([segments[k] for k in part])[1:].replace(SPACE, " ") for part in parts]
        for part, got in zip(parts, self.library.encode(texts, num_threads=1) if texts else []):
            if got != [*chain.from_iterable([found[k] for k in part])]:
                rest.update(part)
        alone = sorted(rest)
        wanted = self.from_library([segments[k] for k in alone]) if alone else []
        return [segments[k] for k, want in zip(alone, wanted) if found[k] != want]

    def forget(self) -> None:
        self.known.clear()
        self.known_text.clear()
        self.wrong.clear()

    def from_library(self, segments: list[str]) -> list[list[int]]:
        """The library's ids of segments.  It puts a space mark before a
        text: segments without one are encoded behind a lone character."""
        lone = self.alone[:1]
        texts = [s[1:].replace(SPACE, " ") if s[0] == SPACE else lone + s for s in segments]
        skip = [0 if s[0] == SPACE else None for s in segments]
        if any(k is None for k in skip):
            head = len(self.library.encode(lone)) if lone else 1
            skip = [head if k is None else k for k in skip]
        got = self.library.encode(texts, num_threads=1)
        # a lone space mark is an empty text to the library
        return [[self.piece_id[SPACE]] if s == SPACE else g[k:] for s, g, k in zip(segments, got, skip)]


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """One row per document row: ``doc_id, n_tokens, ids_sha256,
    decoded_sha256, agrees`` (and ``ids, decoded`` ``with_ids``).

    Ids end with the end id; a null or empty text is the end id alone and
    decodes to the empty text.  ``agrees`` tells whether the library gave
    the same ids for every segment of the text; repeated rows give repeated
    rows."""
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(model_path)
        end = str(m.end_id)
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                cut = [m.segments(m.normalize(t)) for t in texts_of(part.column("text"))]
                if len(m.known) > CACHE_SEGMENTS:
                    m.forget()
                new = set().union(*cut).difference(m.known)
                if new:
                    m.learn(new)
                known, known_text, wrong = m.known.__getitem__, m.known_text.__getitem__, m.wrong
                rows, all_ids = [], []
                for segs in cut:
                    ids = [*chain.from_iterable(map(known, segs)), m.end_id]
                    text = " ".join([*map(known_text, segs), end])
                    rows.append((len(ids), hashlib.sha256(text.encode()).hexdigest(),
                                 not wrong or wrong.isdisjoint(segs)))
                    all_ids.append(ids)
                for s in new:  # very long segments are not worth remembering
                    if len(s) > CACHE_CHARS:
                        del m.known[s], m.known_text[s]
                decoded = m.library.decode(all_ids) if all_ids else []
                shas = [hashlib.sha256(d.encode("utf-8")).hexdigest() for d in decoded]
                n, sha, ok = zip(*rows) if rows else ((), (), ())
                arrays = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha, pa.string()),
                          pa.array(shas, pa.string()), pa.array(ok, pa.bool_())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
                if with_ids:
                    arrays += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = (f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, agrees boolean"
              + ", ids array<int>, decoded string" * with_ids)
    return src.mapInArrow(run, schema)
