"""Lexicon sentiment scorers (L2, L3): two word tables, two rules.

Scorer A adds up graded words and squashes the sum; it looks at words
alone.  Scorer B averages polarities and reads the words around a hit:
boosters strengthen it, negations turn it.  The tables are graded by hand for this
engine in a few whole steps, apart from each other; thresholds and null rules are
the reference's.  Both run over one token array per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Scorer A: words by grade.
GRADES = {
    3: "adore amazing awesome brilliant excellent fantastic loved love outstanding perfect superb terrific wonderful",
    2: "beautiful best delighted enjoy enjoyed glad good great happy helpful impressed nice pleased reliable",
    1: "clean comfortable easy fair fine ok okay quick solid sturdy works worth",
    -1: "cheap dull flimsy late loud meh noisy slow weak wrong",
    -2: "annoying bad broke broken disappointed disappointing faulty poor scum stupid trash ugly useless",
    -3: "awful disgusting hate hated horrible idiot loser moron pathetic terrible worst worthless",
}
# Scorer B: words by polarity, in eighths.
POLARITIES = {
    8: "best excellent perfect love loved superb wonderful",
    6: "amazing awesome fantastic good great happy outstanding",
    4: "nice helpful impressed fine better fun easy pleasant",
    -4: "cheap slow weak noisy boring dull late",
    -6: "bad broken poor disappointing useless stupid trash clown",
    -8: "worst awful terrible horrible hate hated disgusting pathetic worthless",
}
BOOSTERS = "very really extremely so truly absolutely"
NEGATIONS = "not no never hardly without"
# Normalisation of scorer A, x / sqrt(x^2 + alpha); A is positive from 0.05
# on and negative from -0.05 on, B by the sign of its mean.
COMPOUND_ALPHA = 15.0
COMPOUND_THRESHOLD = 0.05
# ---------------------------------------------------------------------------


def _table(by_value: dict[int, str]) -> dict[str, int]:
    return {w: v for v, words in by_value.items() for w in words.split()}


LEXICON_A, LEXICON_B = _table(GRADES), _table(POLARITIES)


def _words(words) -> str:
    return ", ".join(f"'{w}'" for w in sorted(words))


def _lookup(table: dict[str, int], word: str) -> str:
    return f"element_at(map({', '.join(f'{chr(39)}{w}{chr(39)}, {v}' for w, v in sorted(table.items()))}), {word})"


def grade_sum(tokens: str, table: dict[str, int] | None = None) -> Column:
    """Sum of the grades of the tokens in scorer A's table (null tokens: null)."""
    table = LEXICON_A if table is None else table
    hits = f"filter(`{tokens}`, t -> t IN ({_words(table)}))"  # a hash-set test per token
    return F.expr(f"aggregate({hits}, 0, (a, t) -> a + {_lookup(table, 't')})")


def polarity_sum(tokens: str) -> Column:
    """struct(eighths, hits) of scorer B: a hit counts 3/2 behind a booster
    (8 at most), and minus one half if one of the two words before it is a
    negation."""
    at = f"filter(sequence(1, size(`{tokens}`)), i -> element_at(`{tokens}`, i) IN ({_words(LEXICON_B)}))"
    word, before, earlier = (f"try_element_at(`{tokens}`, i{d})" for d in ("", " - 1", " - 2"))
    # position 0 is no position
    before, earlier = f"CASE WHEN i > 1 THEN {before} END", f"CASE WHEN i > 2 THEN {earlier} END"
    raw = _lookup(LEXICON_B, word)
    strong = (f"CASE WHEN coalesce({before} IN ({_words(BOOSTERS.split())}), false) "
              f"THEN least(8, greatest(-8, {raw} * 3 div 2)) ELSE {raw} END")
    turned = (f"coalesce({before} IN ({_words(NEGATIONS.split())}), false) "
              f"OR coalesce({earlier} IN ({_words(NEGATIONS.split())}), false)")
    value = f"CASE WHEN {turned} THEN -(({strong}) div 2) ELSE {strong} END"
    return F.expr(f"CASE WHEN size(`{tokens}`) > 0 THEN aggregate({at}, named_struct('eighths', 0L, 'hits', 0L), "
                  f"(a, i) -> named_struct('eighths', a.eighths + ({value}), 'hits', a.hits + 1)) "
                  f"WHEN `{tokens}` IS NOT NULL THEN named_struct('eighths', 0L, 'hits', 0L) END")


def compound_score(grades: Column) -> Column:
    """Scorer A's score in [-1, 1] from a sum of grades."""
    x = grades.cast("double")
    return x / F.sqrt(x * x + F.lit(COMPOUND_ALPHA))


def sentiment_a(grades: Column) -> Column:
    """L2: compound >= 0.05 positive, <= -0.05 negative, else neutral."""
    c = compound_score(grades)
    return (F.when(grades.isNull(), F.lit(None).cast("string")).when(c >= COMPOUND_THRESHOLD, "positive")
             .when(c <= -COMPOUND_THRESHOLD, "negative").otherwise("neutral"))


def sentiment_b(polarity: Column) -> Column:
    """L3: mean polarity > 0 positive, < 0 negative, 0 or no hit neutral."""
    e = polarity["eighths"]
    return (F.when(e.isNull(), F.lit(None).cast("string")).when(e > 0, "positive")
             .when(e < 0, "negative").otherwise("neutral"))


def mean_polarity(polarity: Column) -> Column:
    """L3 score in [-1, 1]: mean polarity of the hits, 0.0 without hits."""
    return F.when(polarity["hits"] > 0, polarity["eighths"] / (F.lit(8.0) * polarity["hits"])).otherwise(F.lit(0.0))
