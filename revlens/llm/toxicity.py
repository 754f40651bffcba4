"""Toxicity scores behind a noisy-channel deobfuscation.

1. A character trigram model is counted over the words of all documents.
2. Obfuscated spots (leetspeak, stretched letters, letters set apart by
   spaces or punctuation) become lattices: each written character may stand
   for itself, for a letter it is used for, or for nothing, at a cost.  The
   Viterbi path under the character model is the restored text.
3. A logistic model over the word beginnings of the restored text, fitted
   on labelled rows, gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import materialize
from .common import fresh, slices, texts_of

# What a written character may stand for, besides itself.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou", "#": "aeiou"}
#: Signs that may be put between letters.
FILLERS = ".-_*~'`^:,/"
#: Costs (nats) of a substitution, a dropped filler or gap, a stretched letter,
#: and of a sign or digit that stands for itself among letters.
SUBSTITUTE, DROP, STRETCH, ITSELF = 2.0, 1.0, 0.5, 4.0
#: Letters of the character model; all others are one class.
ALPHABET = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœ"
OTHER, EDGE = "?", " "
#: Longest word beginning used as a feature, shortest, and the size of the
#: classifier: at most so many features, the strongest.
LONGEST, SHORTEST, FEATURES = 7, 3, 4096
#: Labelled rows that the classifier is fitted on at most.
TRAIN_ROWS = 20_000
#: Tokens remembered by a scorer.
MEMO = 150_000
#: A feature needs so many labelled documents of the rarer class it speaks for.
MIN_DOCS = 3

_LETTER = re.compile(r"[^\W\d_]")
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
_EDGES = ".,;:!?\"'()[]{}<>«»„“”‘’…|*#%&$-_~`^/+=\\"


class CharModel:
    """Character trigram model with interpolated backing off."""

    def __init__(self, trigrams: dict[str, int]):
        bi, uni = Counter(), Counter()
        for g, n in trigrams.items():
            bi[g[1:]] += n
            uni[g[2]] += n
        lead = Counter()
        for g, n in trigrams.items():
            lead[g[:2]] += n
        lead1 = Counter()
        for g, n in bi.items():
            lead1[g[0]] += n
        self.tri, self.bi, self.uni, self.lead, self.lead1 = trigrams, bi, uni, lead, lead1
        self.total = sum(uni.values()) + len(ALPHABET) + 2
        self.memo: dict[str, float] = {}

    def cost(self, gram: str) -> float:
        """-log P(third character | first two)."""
        got = self.memo.get(gram)
        if got is None:
            p1 = (self.uni.get(gram[2], 0) + 1) / self.total
            p2 = (self.bi.get(gram[1:], 0) + 4 * p1) / (self.lead1.get(gram[1], 0) + 4)
            p3 = (self.tri.get(gram, 0) + 4 * p2) / (self.lead.get(gram[:2], 0) + 4)
            got = self.memo[gram] = -math.log(p3)
        return got


def known(c: str) -> str:
    return c if c in ALPHABET or c == EDGE else OTHER


def step(state: str, c: str) -> str:
    """The last two characters; after a word's end a new word begins."""
    return EDGE * 2 if c == EDGE else state[1] + c


def lattice(written: str) -> list[list[tuple[str, float]]]:
    """Readings of each written character (runs of one letter are one place):
    (what it stands for, cost)."""
    places, i = [], 0
    while i < len(written):
        c, j = written[i], i + 1
        if _LETTER.match(c):
            while j < len(written) and written[j] == c:
                j += 1
            n = j - i
            # a letter once or twice; longer runs are stretched
            options = [(c, 0.0)] if n == 1 else [(c, STRETCH), (c * 2, 0.0 if n == 2 else STRETCH)]
        elif c == EDGE:
            options = [(EDGE, 0.0), ("", DROP)]
        else:
            options = [(x, SUBSTITUTE) for x in LEET.get(c, "")]
            if c in FILLERS:
                options.append(("", DROP))
            if not options or c.isdigit():
                options.append((c, ITSELF))
        places.append(options)
        i = j
    return places


def restore(written: str, model: CharModel) -> str:
    """Viterbi path through the lattice of a spot; states are the last two
    characters, so the work is linear in the spot's length."""
    states: dict[str, tuple[float, tuple | None]] = {EDGE * 2: (0.0, None)}
    for options in [*lattice(written), [(EDGE, 0.0)]]:
        nxt: dict[str, tuple[float, tuple | None]] = {}
        for state, (cost, path) in states.items():
            for out, extra in options:
                s, c, p = state, cost + extra, path
                for ch in out:
                    k = known(ch)
                    c += model.cost(s + k)
                    s = step(s, k)
                if out:
                    p = (p, out)
                old = nxt.get(s)
                if old is None or c < old[0]:
                    nxt[s] = (c, p)
        states = nxt
    path = min(states.values(), key=lambda v: v[0])[1]
    out = []
    while path is not None:
        path, piece = path
        out.append(piece)
    return "".join(reversed(out)).strip()


def suspicious(token: str) -> bool:
    """Letters mixed with signs used for letters or between them, or a
    stretched letter; addresses, links and assignments are left alone."""
    core = token.strip(".,;:?\"'()[]{}<>%&")
    if len(core) < 3 or not _LETTER.search(core):
        return False
    if _STRETCHED.search(core):
        return True
    if core.isalpha() or "://" in core or "=" in core or re.search(r"@.*\.", core):
        return False
    inner = core.rstrip("!*#$@+|")
    inside = [c for c in inner if not c.isalpha()]
    if not inside or not all(c in LEET or c in FILLERS for c in inside):
        return False
    letters = sum(map(str.isalpha, inner))
    return 2 * letters >= len(inside) if any(c in LEET for c in inside) else letters == len(inside) + 1


#: One-letter tokens that may be letters set apart.
SINGLES = frozenset(ALPHABET) | frozenset(LEET)


def readings(token: str, model: CharModel) -> tuple[str, ...]:
    """Words of one lower-case token: as written and, if suspicious, restored."""
    plain = token.strip(_EDGES)
    got = (plain,) if plain else ()
    if not token.isalpha() or _STRETCHED.search(token):
        core = token.strip(".,;:?\"'()[]{}<>%&")
        if suspicious(core):  # signs at the end may be letters or not
            for spot in sorted({core, core.rstrip("!*#$@+|")}):
                got += tuple(restore(spot, model).split())
    return got


def lone(token: str) -> str:
    """The letter of a one-letter token, signs behind it apart, else nothing."""
    one = token if len(token) < 2 else token.rstrip(".,;:?!")
    return one if len(one) == 1 and one in SINGLES else ""


def set_apart(tokens: list[str], model: CharModel) -> set[str]:
    """Words restored from three or more one-letter tokens in a row."""
    words: set[str] = set()
    run: list[str] = []
    for t in [*tokens, ""]:
        if one := lone(t):
            run.append(one)
        else:
            if len(run) >= 3 and len(set(run)) > 1:
                words.update(restore(EDGE.join(run), model).split())
            run = []
    return words


def restored_words(text: str, model: CharModel, memo: dict[str, tuple[str, ...]]) -> set[str]:
    """Lower-case words of a text, plain and as restored."""
    tokens = text.lower().split()
    distinct = set(tokens)
    for t in distinct.difference(memo):
        memo[t] = readings(t, model)
    words = set().union(*map(memo.__getitem__, distinct))
    if len({*map(lone, distinct)} - {""}) >= 2:
        words |= set_apart(tokens, model)
    return words


def word_features(word: str) -> list[str]:
    """Beginnings of a word, and the whole word."""
    return [word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1)] + (["=" + word] if word else [])


@dataclass
class ToxicityModel:
    """Character model (trigram counts) and feature weights."""
    trigrams: dict[str, int]
    weights: dict[str, float]
    bias: float

    def scorer(self):
        """A function text -> score, with memos of its own (bounded)."""
        chars, weights = CharModel(self.trigrams), self.weights
        memo: dict[str, tuple[str, ...]] = {}

        def features(words) -> tuple[str, ...]:
            return tuple(f for w in words for f in word_features(w) if f in weights)

        def score(text: str) -> float:
            if len(memo) > MEMO:
                memo.clear()
            tokens = text.lower().split()
            distinct = set(tokens)
            for t in distinct.difference(memo):
                memo[t] = features(readings(t, chars))
            found = set().union(*map(memo.__getitem__, distinct))
            if len({*map(lone, distinct)} - {""}) >= 2:
                found.update(features(set_apart(tokens, chars)))
            z = self.bias + sum(weights[f] for f in sorted(found))
            return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))
        return score


def char_trigrams(docs: DataFrame, text_col: str = "text") -> dict[str, int]:
    """Trigram counts over the words of all documents.  At most
    (len(ALPHABET) + 2)^3 rows reach the driver, whatever the input."""
    letters = EDGE + OTHER + ALPHABET
    n = len(letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.ones(1 << 16, np.int32)  # others
        for i, c in enumerate(letters):
            number[ord(c)] = i
        for c in [*_EDGES, *"\t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0"]:
            number[ord(c)] = 0
        for b in batches:
            total = np.zeros(n ** 3, np.int64)
            for part in slices([b]):
                text = " ".join(["", *texts_of(part.column(0)), ""]).lower()
                points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
                x = number[np.minimum(points, 0xFFFF)]
                p, q, r = x[:-2], x[1:-1], x[2:]
                p = np.where(q == 0, 0, p)  # a word begins
                # ends follow words; stretched letters teach nothing
                fine = ((q != 0) | (r != 0)) & ~((p == q) & (q == r))
                total += np.bincount(((p * n + q) * n + r)[fine], minlength=n ** 3)
            at = np.flatnonzero(total)
            grams = [letters[i // n // n] + letters[i // n % n] + letters[i % n] for i in at.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(total[at])], names=["g", "n"])

    got = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "g string, n bigint")
    return {r.g: r.n for r in got.groupBy("g").agg(F.sum("n").alias("n")).collect()}


def fit_logistic(rows: list[list[int]], labels: np.ndarray, n: int, l2: float = 1e-3, steps: int = 400):
    """Weights and bias of an L2 logistic model over sets of feature numbers
    (full-batch descent with momentum; deterministic)."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feat = np.fromiter((f for r in rows for f in r), np.int64, len(at))
    w, v = np.zeros(n + 1), np.zeros(n + 1)
    w[n] = math.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
    for _ in range(steps):
        z = np.bincount(at, w[feat], len(rows)) + w[n]
        g = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels
        grad = np.append(np.bincount(feat, g[at], n) / len(rows) + l2 * w[:n], g.mean())
        v = 0.9 * v - 2.0 * grad
        w = w + v
    return w[:n], float(w[n])


def strongest_features(lab: DataFrame, n: int, pos: int, features: int) -> list[str]:
    """Features of the words of ``lab`` (``y, words``; ``n`` documents, ``pos``
    of them toxic) that speak for toxicity, the strongest first.  A document
    counts once for a feature however many of its words have it."""
    ends = F.sequence(F.lit(SHORTEST), F.lit(LONGEST))

    def of_word(w):
        starts = F.transform(F.filter(ends, lambda k: k <= F.length(w)), lambda k: F.substring(w, F.lit(1), k))
        return F.concat(starts, F.array(F.concat(F.lit("="), w)))

    each = F.array_distinct(F.flatten(F.transform("words", of_word)))
    counted = (lab.select("y", F.explode(each).alias("f")).groupBy("f")
                  .agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n")).where(f"pos >= {MIN_DOCS}"))
    lift = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("n") - F.col("pos") + 0.5) / (n - pos + 1))
    best = (counted.withColumn("lift", lift).where("lift > 1")
                   .orderBy((F.col("lift") * F.sqrt("pos")).desc(), "f").limit(features).collect())
    return [r.f for r in best]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", train_rows: int = TRAIN_ROWS, features: int = FEATURES) -> ToxicityModel:
    """Character model over all documents; classifier of at most ``features``
    word features over at most ``train_rows`` labelled documents (those of
    the smallest id hashes; the only sample here).  Null labels and ids teach nothing; an id labelled
    both ways counts as toxic; without both classes the score is the share
    of toxic labels (0.5 if there is none)."""
    trigrams = char_trigrams(docs, text_col)
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
                   .where("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))
                   .orderBy(F.xxhash64("id"), "id").limit(train_rows))
    marks = materialize(marks, "labels")
    mine = marks.select(F.col("id").alias("of"), "y")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars, memo = CharModel(trigrams), {}
        for b in slices(batches):
            if len(memo) > MEMO:
                memo.clear()
            words = [sorted(restored_words(t, chars, memo)) for t in texts_of(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.list_(pa.string()))],
                                             names=["y", "words"])

    # the label rows are bounded by train_rows
    lab = (texts.join(F.broadcast(mine), texts["id"] == mine["of"]).dropDuplicates(["id"]).select("y", "text")
                .mapInArrow(words_of, "y int, words array<string>"))
    lab = materialize(lab, "labelled")
    size = lab.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("pos")).first()
    if not size.pos or size.pos == size.n:
        share = size.pos / size.n if size.n else 0.5
        share = min(1 - 1e-6, max(1e-6, share))
        return ToxicityModel(trigrams, {}, math.log(share / (1 - share)))
    number = {f: i for i, f in enumerate(strongest_features(lab, size.n, size.pos, features))}

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([sorted({number[f] for w in words for f in word_features(w) if f in number})
                                        for words in b.column(1).to_pylist()], pa.list_(pa.int32()))],
                names=["y", "x"])

    # bounded by train_rows
    rows = sorted(lab.mapInArrow(chosen, "y int, x array<int>").collect(), key=lambda r: (r.y, r.x))
    w, bias = fit_logistic([r.x for r in rows], np.array([r.y for r in rows], float), len(number))
    return ToxicityModel(trigrams, {f: float(w[i]) for f, i in number.items()}, bias)


def in_fold(id_col: str, folds: int = 5) -> Column:
    """True where crc32 of the id as text is divisible by ``folds``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0


def add_score(docs: DataFrame, model: ToxicityModel, text_col: str, out: str) -> DataFrame:
    """``docs`` with a score column; null texts are empty."""
    schema = StructType([*docs.schema.fields, StructField(out, DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for b in slices(batches):
            s = [score(t) for t in texts_of(b.column(at).cast(pa.string()))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())],
                                             names=[*b.schema.names, out])

    return docs.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document row.  Labels of
    held-out ids (and null ids) are never learned from; null and empty texts
    get the model's base score; repeated rows score alike."""
    model = fit(docs, labels.where(~in_fold(id_col)), id_col, text_col, label_col, train_rows)
    scored = add_score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")),
                       model, "text", "score")
    return scored.select("doc_id", F.coalesce(in_fold("doc_id"), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score is below 0.5, with their columns."""
    model = fit(docs, labels.where(~in_fold(id_col)), id_col, text_col, label_col, train_rows)
    out = fresh(docs, "_toxicity")
    return add_score(docs, model, text_col, out).where(F.col(out) < 0.5).select(*docs.columns)
