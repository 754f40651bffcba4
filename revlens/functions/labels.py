"""Label rules and label/score helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- fixed values -----------------------------------------------------------
# Class encoding used by every model script.
LABEL_TO_ID = {"positive": 0, "negative": 1, "neutral": 2}
# Capitalised names returned for class ids 0, 1, 2.
ID_TO_NAME = ["Positive", "Negative", "Neutral"]
# ---------------------------------------------------------------------------


# --- fixed values: the rating rule -------------------------------------------
HIGH_RATING, LOW_RATING, MANY_VOTES = 4, 2, 5
RATING_POINTS, EXTRA_POINTS = 1.0, 0.5
POSITIVE_ABOVE, NEGATIVE_BELOW = 1.0, 0.0
# ---------------------------------------------------------------------------


def heuristic_sentiment(rating, verified=None, helpful=None) -> Column:
    """L1: rating rule.  A rating of 4 or more scores +1, of 2 or less -1; a
    verified purchase and 5 helpful votes or more score +0.5 each.  Above 1
    positive, below 0 negative, else neutral.  A missing verified flag counts
    as False and a missing vote count as 0.  (Halves are exact in binary.)"""
    r = _c(rating)
    score = F.when(r >= HIGH_RATING, RATING_POINTS).when(r <= LOW_RATING, -RATING_POINTS).otherwise(0.0)
    if verified is not None:
        score = score + F.when(F.coalesce(_c(verified), F.lit(False)), EXTRA_POINTS).otherwise(0.0)
    if helpful is not None:
        score = score + F.when(F.coalesce(_c(helpful), F.lit(0)) >= MANY_VOTES, EXTRA_POINTS).otherwise(0.0)
    return (F.when(score > POSITIVE_ABOVE, "positive").when(score < NEGATIVE_BELOW, "negative")
             .otherwise("neutral"))


def majority_vote(*votes) -> Column:
    """L4: positive if p > n and p >= u; negative if n > p and n > u; else
    neutral.  A null vote counts for nothing."""
    if all(isinstance(v, str) for v in votes):
        def n(label):
            return "(" + " + ".join(f"CAST(coalesce(`{v}` = '{label}', false) AS INT)" for v in votes) + ")"
        p, ng, u = n("positive"), n("negative"), n("neutral")
        return F.expr(f"CASE WHEN {p} > {ng} AND {p} >= {u} THEN 'positive' "
                      f"WHEN {ng} > {p} AND {ng} > {u} THEN 'negative' ELSE 'neutral' END")

    def cnt(label):
        return sum((F.coalesce(_c(v) == label, F.lit(False))).cast("int") for v in votes)
    p, n, u = cnt("positive"), cnt("negative"), cnt("neutral")
    return (F.when((p > n) & (p >= u), "positive")
             .when((n > p) & (n > u), "negative")
             .otherwise("neutral"))


def encode_label(col, strict: bool = False) -> Column:
    """P5: positive/negative/neutral -> 0/1/2.  Unknown -> null, or an error
    when ``strict`` (the dictionary-lookup form)."""
    c = _c(col)
    e = F.when(c == "positive", 0).when(c == "negative", 1).when(c == "neutral", 2)
    if strict:
        e = F.when(e.isNull(), F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(c, F.lit("null"))))).otherwise(e)
    return e.cast("int")


def decode_label(col) -> Column:
    """Class id -> capitalised name (out of range -> null)."""
    return F.try_element_at(F.array(*[F.lit(x) for x in ID_TO_NAME]), (_c(col) + 1).cast("int"))


def softmax(col) -> Column:
    """Softmax of a numeric array, shifted by its max for stability."""
    v = _c(col)
    m = F.array_max(v)
    ex = F.transform(v, lambda x: F.exp(x - m))
    tot = F.aggregate(ex, F.lit(0.0), lambda a, x: a + x)
    return F.transform(ex, lambda x: x / tot)


def argmax(col) -> Column:
    """Index of the largest element, first index on ties."""
    v = _c(col)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def strict_argmax_label(col) -> Column:
    """Positive/Negative only when that score is strictly the largest;
    every tie for the top gives Neutral."""
    v = _c(col)
    a, b, c = v[0], v[1], v[2]
    return (F.when((a > b) & (a > c), "Positive")
             .when((b > a) & (b > c), "Negative")
             .otherwise("Neutral"))
