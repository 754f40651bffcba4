"""Phrase collocations by best-first branch-and-bound growth.

Words and two-word phrases are counted first.  The count of a prefix bounds
what any phrase grown from it can score: a phrase p of first word w and
prefix q has f(p) <= f(q) and f(p) <= f(rest), so its cut after w scores at
most f(p) / f(w) <= f(q) / f(w).  Each language has a frontier score t; only
prefixes with a bound of t or more grow, best first.  When the language has
``top`` surviving phrases of score t or more, no unexpanded prefix can reach
them and the language is settled, ties included; otherwise t sinks and more
prefixes grow.  A two-word phrase of score t or more also needs the longer
phrases around it, which may drop it, so it grows to the left as well.

Counting runs in numpy over about 2 MB of text at a time, whatever the text
lengths; Spark sums the parts by phrase.  A fixed bitmap of frequent and
growing phrases spares the third word where it cannot matter; its hash
collisions only let more through, and an exact join decides.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import top_k_per_group
from ..session import materialize

#: Fixed values of the scores and of what ends a piece or a word.
SCALE = 1_000_000
BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Bytes of text counted at a time, and held for all languages of a task.
CHUNK = 2 << 20
HELD = 8 << 20
#: Rows of counts sent on at a time.
ROWS = 50_000
#: Slots of the bitmap (2^24, four bits each: 8 MB), and its flags.
SLOT_BITS = 24
FREQUENT, GROWS, LEADS = 1, 2, 4
#: First frontier: so many times ``top`` phrases; each round so many times more.
WIDTH = 2
WIDEN = 4

_MAP = bytes(ord(".") if c in BREAKS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens_of(raw: bytes) -> list[bytes]:
    """Lower-cased words of UTF-8 bytes; ``b"."`` ends a piece."""
    return [t for t in raw.translate(_MAP).replace(b".", b" . ").split(b" ") if t]


def _chunks(raw: bytes, chunk: int) -> Iterator[bytes]:
    """Bytes cut at spaces or breaks into parts of about ``chunk``."""
    at = 0
    ends = frozenset(BREAKS + b" \t")
    while at < len(raw):
        end = min(len(raw), at + chunk)
        while end < len(raw) and raw[end] not in ends:
            end += 1
        yield raw[at:end]
        at = end


class _Words:
    """Words of some tokens as numbers; 0 is the end of a piece."""

    def __init__(self, tokens: list[bytes]):
        numbers: defaultdict = defaultdict()
        numbers.default_factory = numbers.__len__
        numbers[b"."]
        self.ids = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
        self.words = list(numbers)
        self.arrow = pa.array(self.words, pa.binary())

    def phrases(self, *columns) -> pa.Array:
        parts = [self.arrow.take(pa.array(c)) for c in columns]
        joined = parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
        return joined.cast(pa.string())


def _short_counts(tokens: list[bytes], old: int):
    """Phrases of one and two words that end behind the first ``old`` tokens:
    (phrases, counts, size); the empty phrase of size 0 counts all words."""
    w = _Words(tokens)
    ids, n = w.ids, len(w.words)
    ones = np.bincount(ids[old:], minlength=n)
    ones[0] = 0
    some = np.flatnonzero(ones)
    yield pa.array([""]), ones.sum(keepdims=True), 0
    yield w.phrases(some), ones[some], 1
    a, b = ids[:-1], ids[1:]
    ok = (a > 0) & (b > 0)
    ok[:max(0, old - 1)] = False
    code, count = np.unique(a[ok] * n + b[ok], return_counts=True)
    yield w.phrases(code // n, code % n), count, 2


def slot_of(lang: Column, phrase: Column) -> Column:
    """Bitmap slot of a phrase, the same as `_slots`."""
    return F.xxhash64(lang, phrase).bitwiseAND(F.lit((1 << SLOT_BITS) - 1))


def _slots(lang: str, phrases: pa.Array) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(p.encode(), seed) & ((1 << SLOT_BITS) - 1) for p in phrases.to_pylist()),
                       np.int64, len(phrases))


def _long_counts(tokens: list[bytes], old: int, lang: str, bitmap: np.ndarray):
    """Three-word phrases whose two-word parts the bitmap lets grow."""
    w = _Words(tokens)
    ids, n = w.ids, len(w.words)
    a, b = ids[:-1], ids[1:]
    ok = (a > 0) & (b > 0)
    code, at = np.unique(np.where(ok, a * n + b, -1), return_inverse=True)
    flags = np.zeros(len(code), np.uint8)
    real = code >= 0
    slots = _slots(lang, w.phrases(code[real] // n, code[real] % n))
    flags[real] = bitmap[slots >> 1] >> ((slots & 1) * 4).astype(np.uint8) & 15
    pair = flags[at]
    left, right = pair[:-1], pair[1:]
    take = (left & FREQUENT > 0) & (right & FREQUENT > 0) & ((left & GROWS > 0) | (right & LEADS > 0))
    take[:max(0, old - 2)] = False
    first, third = at[:-1][take], ids[2:][take]
    both, count = np.unique(first * n + third, return_counts=True)
    pairs = code[both // n]
    yield w.phrases(pairs // n, pairs % n, both % n), count, 3


def _counter(count, chunk: int, held: int):
    """mapInArrow function: texts by language, some MB at a time, counted by
    ``count(tokens, old, lang)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def flush(lang: str):
            texts = waiting.pop(lang)
            sizes.pop(lang)
            carry: list[bytes] = []
            for part in _chunks(b".".join(texts), chunk):
                tokens = carry + tokens_of(part)
                for phrases, n, size in count(tokens, len(carry), lang):
                    rows = pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(lang), len(n)), phrases, pa.repeat(pa.scalar(size, pa.int32()), len(n)),
                         pa.array(n, pa.int64())], names=["lang", "phrase", "size", "n"])
                    for lo in range(0, rows.num_rows, ROWS):
                        yield rows.slice(lo, ROWS)
                carry = tokens[-2:]

        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    raw = text.encode()
                    waiting.setdefault(lang, []).append(raw)
                    sizes[lang] = sizes.get(lang, 0) + len(raw)
                    if sizes[lang] >= chunk:
                        yield from flush(lang)
                while sum(sizes.values()) > held:
                    yield from flush(max(sizes, key=sizes.get))
        for lang in list(waiting):
            yield from flush(lang)
    return run


_COUNTS = "lang string, phrase string, size int, n bigint"


def _counted(docs: DataFrame, count, chunk: int, held: int) -> DataFrame:
    return (docs.mapInArrow(_counter(count, chunk, held), _COUNTS)
                .groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n")))


def _bitmap(flagged: DataFrame) -> np.ndarray:
    """Flags of phrases as a bitmap: at most 2^20 longs reach the driver,
    whatever the number of phrases."""
    rows = (flagged.select(slot_of(F.col("lang"), F.col("phrase")).alias("slot"), "flags")
                   .groupBy(F.shiftright("slot", 4).alias("cell"))
                   .agg(F.bit_or(F.expr("shiftleft(cast(flags as bigint), cast((slot & 15) * 4 as int))")).alias("bits"))
                   .toArrow())
    cells = np.zeros(1 << (SLOT_BITS - 4), "<u8")
    cells[rows["cell"].to_numpy()] = rows["bits"].to_numpy().view("<u8")
    return cells.view(np.uint8)  # two slots a byte, the lower one first


def _floor_score(a: str, left: str, right: str) -> Column:
    """floor(SCALE a a / (left right)), exact in 38 digits."""
    return F.expr(f"cast(({SCALE} * cast({a} as decimal(19, 0)) * cast({a} as decimal(19, 0))) "
                  f"div (cast({left} as decimal(19, 0)) * cast({right} as decimal(19, 0))) as bigint)")


def collocations(docs: DataFrame, top: int = 2000, min_count: int = 10, cover: int = 50, lang_col: str = "lang",
                 text_col: str = "text", chunk: int = CHUNK, held: int = HELD, width: int = WIDTH) -> DataFrame:
    """The first ``top`` phrases of two and three words per language:
    ``lang, rank, phrase, a, l, r, n, score``.

    A phrase counts in all its places inside pieces; with ``min_count`` it is
    a candidate, dropped if a longer candidate around it has ``cover``
    percent of its count.  Its score is that of its worst cut (the first on
    ties).  Order: score and count falling, then the phrase by its bytes.
    Null languages are ``und``; null and empty texts hold no words; repeated
    rows count each; languages without candidates and empty tables give no
    rows.  The frontier widens fourfold until it holds all prefixes, so the
    rounds are at most the logarithm (base 4) of the two-word phrases."""
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                      F.col(text_col).cast("string").alias("text")).where("text <> ''")
    short = _counted(src, lambda tokens, old, _: _short_counts(tokens, old), chunk, held)
    # words of a candidate are at least as frequent as the candidate
    short = materialize(short.where((F.col("size") == 0) | (F.col("n") >= min_count)), "phrases")
    ones = short.where("size = 1").select("lang", F.col("phrase").alias("word"), F.col("n").alias("f"))
    totals = short.where("size = 0").select("lang", "n")
    two = short.where("size = 2").select(
        "lang", "phrase", F.col("n").alias("a"), F.substring_index("phrase", " ", 1).alias("w1"),
        F.substring_index("phrase", " ", -1).alias("w2"))

    def with_word(df: DataFrame, word: str, name: str) -> DataFrame:
        side = ones.select("lang", F.col("word").alias(word), F.col("f").alias(name))
        return df.join(side, ["lang", word])

    pairs = with_word(with_word(two, "w1", "f1"), "w2", "f2")
    pairs = materialize(pairs.select("lang", "phrase", "a", "f1", "f2", _floor_score("a", "f1", "f2").alias("score"),
                                     F.expr(f"cast({SCALE} * cast(a as decimal(19, 0)) div f1 as bigint)").alias("bound")),
                        "pairs")
    # phrases per score: at most SCALE + 1 rows a language
    by_score = pairs.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("c"))
    falling = Window.partitionBy("lang").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    by_score = materialize(by_score.withColumn("upto", F.sum("c").over(falling)), "scores")

    def frontier(goal: int) -> DataFrame:
        """Score t of each language: that of its ``goal``-th phrase, else 0."""
        return by_score.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("upto") >= goal, F.col("score"))),
                                                       F.lit(0)).alias("t"))

    goal, done, open_langs = top * width, None, None
    while True:
        t = frontier(goal)
        if open_langs is not None:
            t = t.join(open_langs, "lang", "left_semi")
        t = materialize(t, "frontier")
        live = pairs.join(t, "lang")
        leads, grows = F.col("score") >= F.col("t"), F.col("bound") >= F.col("t")
        flags = F.lit(FREQUENT) + F.when(grows, GROWS).otherwise(0) + F.when(leads, LEADS).otherwise(0)
        shared = spark.sparkContext.broadcast(_bitmap(live.select("lang", "phrase", flags.alias("flags"))))
        texts = src if open_langs is None else src.join(open_langs, "lang", "left_semi")

        def grown(tokens, old, lang):
            return _long_counts(tokens, old, lang, shared.value)

        three = _counted(texts, grown, chunk, held).where(F.col("n") >= min_count)
        three = materialize(_scored_triples(three, pairs), "triples")
        shared.unpersist()
        found = materialize(_survivors(live, three.join(t, "lang"), cover), "survivors")
        settled = found.groupBy("lang").agg(F.count(F.lit(1)).alias("have"))
        state = materialize(t.join(settled, "lang", "left").select(
            "lang", ((F.col("t") == 0) | (F.coalesce("have", F.lit(0)) >= top)).alias("settled")), "settled")
        part = found.join(state.where("settled"), "lang", "left_semi")
        done = part if done is None else done.unionByName(part)
        open_langs = state.where("not settled").select("lang")
        if open_langs.isEmpty():
            break
        goal *= WIDEN

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    return (top_k_per_group(done, ["lang"], order, top, "rank").join(totals, "lang")
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def _scored_triples(three: DataFrame, pairs: DataFrame) -> DataFrame:
    """Counted three-word phrases with the counts of their parts and the cut
    of the lowest score.  Parts of a frequent phrase are frequent, so the
    inner joins lose none."""
    w = F.split("phrase", " ", 3)
    df = three.select("lang", "phrase", F.col("n").alias("a"), F.concat_ws(" ", w[0], w[1]).alias("head"),
                      F.concat_ws(" ", w[1], w[2]).alias("tail"), w[2].alias("last"))
    df = df.join(pairs.select("lang", F.col("phrase").alias("head"), F.col("a").alias("f12"), "f1"), ["lang", "head"])
    df = df.join(pairs.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("f23"),
                              F.col("f2").alias("f3")), ["lang", "tail"])
    df = df.withColumn("s1", _floor_score("a", "f1", "f23")).withColumn("s2", _floor_score("a", "f12", "f3"))
    first = F.col("s1") <= F.col("s2")
    return df.select("lang", "phrase", "a", "head", "tail", F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                     F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))


def _survivors(live: DataFrame, three: DataFrame, cover: int) -> DataFrame:
    """Phrases of the frontier score or more that no longer one covers."""
    cols = ["lang", "phrase", "a", "l", "r", "score"]
    two = live.where("score >= t").select("lang", "phrase", "a", F.col("f1").alias("l"), F.col("f2").alias("r"), "score")
    around = (three.select("lang", F.explode(F.array("head", "tail")).alias("phrase"), "a")
                   .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    two = two.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a")))
    return two.select(*cols).unionByName(three.where("score >= t").select(*cols))
