"""Personal data by weak supervision.

Base spans follow fixed patterns.  Wider patterns propose further
candidates; format, validity, gazetteer, context and neighbourhood labelers
vote on each one (for, against or not at all).  Expectation-maximisation
over the vote patterns of the whole corpus estimates how reliable each
labeler is and how likely each pattern is personal data; a logistic span
classifier over votes and shape, trained on those likelihoods, decides which
candidates become spans beside the base ones.

Only counts per (kind, votes, shape) reach the driver: a number that the
labelers bound, not the input.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from .common import slices, texts_of

KINDS = ("email", "ip", "card", "phone")
#: Candidates at or above this probability become spans.
ACCEPT = 0.5

# --- fixed values: base patterns ------------------------------------------------
EMAIL_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# --------------------------------------------------------------------------------

# Candidates beyond the base.
_WIDE = {
    "email": re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64}\s?(?:@|\(at\)|\[at\]|\sat\s)\s?[\w-]{1,63}"
                        r"(?:\s?(?:\.|\(dot\)|\[dot\]|\sdot\s)\s?[\w-]{2,63}){1,4}"),
    "ip": re.compile(r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"),
    "card": re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5})"
                       r"(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?|00[0-9]{1,3}[ .-])?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])"
                        r"[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"),
}
# Gazetteers.
_TLDS = frozenset("com org net edu gov io info biz de fr es it nl uk eu us ca ch at be pl se no dk fi jp cn in au br".split())
_ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|36|30[0-5]")
# Country codes of the numbering plan: all of one and two digits, then every
# three digit one of the listed zones that is assigned.
_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 "
                   "66 81 82 84 86 90 91 92 93 94 95 98".split()) | (
    frozenset(f"{zone}{d}" for zone in "21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split()
              for d in range(10))
    - frozenset("210 214 215 217 219 259 292 293 294 295 296 384 388 422 424 425 426 427 428 429 671 684 693 694 695 696 "
                "697 698 699 801 802 803 804 805 806 807 809 851 854 857 858 859 871 872 873 874 875 876 877 879 884 885 "
                "887 889 969 978 990 991 997".split()))
# What every email of the wide pattern has inside.
_AT = re.compile(r"(?:@|\(at\)|\[at\]|\sat\s)\s?[\w-]{1,63}\s?(?:\.|\(dot\)|\[dot\]|\sdot\s)\s?[\w-]{2}")
# Words near a span that speak for its kind, and text before it that speaks against any.
_NEAR = {"email": re.compile(r"mail|contact|write|reach|kontakt|correo|courriel"),
         "ip": re.compile(r"\bip\b|address|host|server|login|adresse"),
         "card": re.compile(r"card|visa|credit|payment|karte|carte|tarjeta"),
         "phone": re.compile(r"phone|call|tel|mobile|fax|anruf|llam|appel")}
_AGAINST = re.compile(r"(?:version|v\.|isbn|token|password|key|sha|hash|section|id)\W{0,4}$")
LABELERS = ("format", "validity", "gazetteer", "context", "neighbours")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then start; per kind leftmost and
    non-overlapping, linear in the text's length."""
    out = []
    at, last = text.find("@"), 0
    while at >= 0:
        m = EMAIL_DOMAIN.match(text, at)
        nxt = at + 1
        if m:
            start = at
            while start > last and text[start - 1] in EMAIL_LOCAL:
                start -= 1
            if start < at:
                out.append(("email", start, m.end()))
                last = nxt = m.end()
        at = text.find("@", nxt)
    for m in NUMBERS.finditer(text):
        if m.group().count(".") >= 3:
            parts, pos = m.group().split("."), m.start()
            for i in range(0, len(parts) - 3, 4):
                size = sum(map(len, parts[i:i + 4])) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i:i + 4]):
                    out.append(("ip", pos, pos + size))
                pos += size + 1
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def votes(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """The labelers' votes (1 for, -1 against, 0 none) on a candidate."""
    span = text[start:end]
    digits = re.sub(r"[^0-9]", "", span)
    before, after = text[max(0, start - 40):start].lower(), text[end:end + 40].lower()
    if kind == "email":
        plain = "@" in span and not re.search(r"\s", span)
        domain = re.split(r"@|\(at\)|\[at\]|\sat\s", span)[-1]
        tld = re.split(r"\.|\(dot\)|\[dot\]|\sdot\s", domain)[-1].strip().lower()
        v = [1 if plain else 0, 1 if plain and span.isascii() else -1 if " at " in span and "dot" not in span else 0,
             1 if tld in _TLDS else -1 if not tld.isalpha() else 0]
    elif kind == "ip":
        parts = [int(p) for p in span.split(".")]
        v = [1 if all(p == str(int(p)) for p in span.split(".")) else -1, 1 if max(parts) <= 255 else -1,
             -1 if parts[0] in (0, 127, 255) or max(parts) < 20 else 1]
    elif kind == "card":
        v = [1 if len(digits) in (15, 16) else 0, 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1,
             1 if _ISSUERS.match(digits) else -1]
    else:
        code = re.match(r"\+([0-9]{1,3})", span)
        v = [1 if code or "(" in span else 0, 1 if 9 <= len(digits) <= 15 else -1,
             (1 if any(code.group(1)[:n] in _CODES for n in (1, 2, 3)) else -1) if code else 0]
    v.append(1 if _NEAR[kind].search(before + " " + after) else -1 if _AGAINST.search(before) else 0)
    left, right = before[-1:], after[:1]
    v.append(-1 if (left and (left.isalnum() or left in "_=#/")) or (right and (right.isalnum() or right in "_=/"))
             else 1)
    return tuple(v)


def shape(kind: str, span: str) -> tuple[int, ...]:
    """Small counts that describe a span: separators, digits, length."""
    digits = sum(c.isdigit() for c in span)
    return (min(3, sum(not c.isalnum() for c in span) // 2), min(4, digits // 4), min(3, len(span) // 8))


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of the wide patterns that overlap no base span of their kind."""
    digit = re.search(r"[0-9]", text) is not None
    out = []
    for kind, pattern in _WIDE.items():
        if kind == "email":
            if not _AT.search(text):
                continue
        elif not digit:
            continue
        own = [(s, e) for k, s, e in base if k == kind]
        for m in pattern.finditer(text):
            if is_free(own, m.start(), m.end()):
                out.append((kind, m.start(), m.end()))
    return out


def is_free(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a span overlaps none of the sorted, disjoint spans ``taken``."""
    i = bisect_left(taken, (end,))
    return i == 0 or taken[i - 1][1] <= start


# --- models over vote patterns ----------------------------------------------------

def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100):
    """Expectation-maximisation of a two-class model whose labelers vote
    independently given the class.  Returns (P(personal) of each pattern,
    P(vote | class) as [class][labeler][vote + 1])."""
    n, k = patterns.shape
    post = 1 / (1 + np.exp(-1.0 * patterns.sum(axis=1)))  # starts from the majority
    tables = np.zeros((2, k, 3))
    for _ in range(rounds):
        prior = ((post * counts).sum() + 1) / (counts.sum() + 2)
        for c, p in enumerate((1 - post, post)):
            for j in range(k):
                tables[c, j] = np.bincount(patterns[:, j] + 1, p * counts, 3) + 1
                if c:  # the labelers are better than chance
                    tables[c, j] += (0, 0, 2)
                else:
                    tables[c, j] += (2, 0, 0)
                tables[c, j] /= tables[c, j].sum()
        log = [np.log(tables[c][np.arange(k), patterns + 1]).sum(axis=1) for c in (0, 1)]
        z = np.log(prior) - np.log1p(-prior) + log[1] - log[0]
        new = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return post, tables


def design(v: np.ndarray, s: np.ndarray) -> np.ndarray:
    return np.hstack([v == 1, v == -1, *(s[:, [j]] == np.arange(5) for j in range(s.shape[1]))]).astype(float)


def train(v: np.ndarray, s: np.ndarray, target: np.ndarray, counts: np.ndarray, steps: int = 500):
    """Weighted logistic regression of ``target`` on votes and shape."""
    x, w, b, share = design(v, s), None, 0.0, counts / counts.sum()
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        g = (1 / (1 + np.exp(-np.clip(x @ w + b, -50, 50))) - target) * share
        w -= 2.0 * (x.T @ g + 1e-3 * w)
        b -= 2.0 * g.sum()
    return w, b


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fit(docs: DataFrame, text_col: str = "text") -> dict[tuple, float]:
    """(kind, votes, shape) -> probability, from all candidates of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter = Counter()
            for t in chain.from_iterable(texts_of(part.column(0)) for part in slices([b])):
                base = base_spans(t)
                for kind, s, e in base + candidates(t, base):
                    seen[(KINDS.index(kind), *votes(kind, t, s, e), *shape(kind, t[s:e]))] += 1
            key = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.list_(pa.int32())),
                                              pa.array([seen[k] for k in key], pa.int64())], names=["key", "n"])

    rows = (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "key array<int>, n bigint")
                .groupBy("key").agg(F.sum("n").alias("n")).collect())
    out: dict[tuple, float] = {}
    k = len(LABELERS)
    for i, kind in enumerate(KINDS):
        mine = sorted((tuple(r.key), r.n) for r in rows if r.key[0] == i)
        if not mine:
            continue
        v = np.array([key[1:1 + k] for key, _ in mine])
        s = np.array([key[1 + k:] for key, _ in mine])
        n = np.array([c for _, c in mine], float)
        post, _ = estimate(v, n)
        w, b = train(v, s, post, n)
        p = 1 / (1 + np.exp(-np.clip(design(v, s) @ w + b, -50, 50)))
        out.update({(kind, *key[1:]): float(x) for (key, _), x in zip(mine, p)})
    return out


def all_spans(text: str, model: dict[tuple, float]) -> tuple[list, list]:
    """(base spans, all spans): accepted candidates are added, the likeliest
    first, unless they overlap a span of their kind."""
    base = base_spans(text)
    extra = []
    for kind, s, e in candidates(text, base):
        p = model.get((kind, *votes(kind, text, s, e), *shape(kind, text[s:e])), 0.0)
        if p >= ACCEPT:
            extra.append((-p, kind, s, e))
    spans = list(base)
    taken = {k: [(s, e) for kind, s, e in base if kind == k] for k in KINDS}
    for _, kind, s, e in sorted(extra):
        if is_free(taken[kind], s, e):
            insort(taken[kind], (s, e))
            spans.append((kind, s, e))
    spans.sort(key=lambda x: (KINDS.index(x[0]), x[1]))
    return base, spans


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: ``doc_id, n_email, n_ip, n_card, n_phone``
    (base spans), ``base_sha256`` and ``spans`` (``kind:start:end``, code
    points, end exclusive).  Null and empty texts have no spans; repeated
    rows give repeated rows."""
    model = fit(docs, text_col)
    src = _texts(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            counts, shas, strings = [], [], []
            for t in texts_of(b.column("text")):
                base, spans = all_spans(t, model)
                n = Counter(k for k, _, _ in base)
                counts.append([n[k] for k in KINDS])
                shas.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                strings.append(_joined(spans))
            cols = np.array(counts, np.int64).reshape(-1, len(KINDS)).T
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, cols), pa.array(shas, pa.string()),
                                              pa.array(strings, pa.string())],
                                             names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return src.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"n_{k} bigint" for k in KINDS)
                          + ", base_sha256 string, spans string")


def mask_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with its spans replaced by ``[KIND]``; spans of several kinds
    that overlap become one mark, named by the first."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    out.append(text[at:])
    return "".join(out)


def mask(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in the texts and ``chars_col``, if
    there, set to the new length.  Null texts stay null; no row goes."""
    model = fit(docs, text_col)
    at = docs.columns.index(text_col)
    src = docs.withColumn(text_col, F.col(text_col).cast(StringType()))
    n_at = src.columns.index(chars_col) if chars_col in src.columns else None
    if n_at is not None:
        src = src.withColumn(chars_col, F.col(chars_col).cast(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            old = b.column(at).to_pylist()
            new = [t if not t else mask_text(t, all_spans(t, model)[1]) for t in old]
            cols = list(b.columns)
            cols[at] = pa.array(new, pa.string())
            if n_at is not None:
                cols[n_at] = pa.array([n if x == y else len(y) for n, x, y in
                                       zip(cols[n_at].to_pylist(), old, new)], pa.int64())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return src.mapInArrow(run, src.schema)
