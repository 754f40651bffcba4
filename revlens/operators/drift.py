"""Drift detection.

KS statistics are computed from value counts: each sample is aggregated by
distinct value, the two counts are cumulated along the value order with the
distributed running sum, and D is the largest ECDF gap - no sample is ever
collected or sorted in one task.  The p-value of small samples is exact, by
the recurrence of the paths that two merged samples can take; large samples
take the asymptotic series.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import word_tokens
from ..session import materialize
from ..sources.commitlog import read_latest, write_run
from .ordering import rank_within, running_sum

P_THRESHOLD = 0.05
KS_TERMS = 100        # terms of the Kolmogorov series
KS_SMALL_LAMBDA = 0.2  # below this the survival function is 1 to double precision
KS_EXACT_MAX = 10_000  # samples up to this size have an exact p-value


def word_frequencies(df: DataFrame, text_col: str = "cleaned_text") -> DataFrame:
    """(Feature, Frequency) over the non-null texts: lower-cased tokens
    of >= 2 word characters.  Map-side partial counts, so a very frequent
    word costs one row per task in the shuffle."""
    toks = df.filter(F.col(text_col).isNotNull()).select(F.explode(word_tokens(text_col)).alias("Feature"))
    return toks.groupBy("Feature").agg(F.count(F.lit(1)).alias("Frequency"))


def kolmogorov_sf(lam: Column) -> Column:
    """Q(lambda) = 2 * sum_{j>=1} (-1)^(j-1) exp(-2 j^2 lambda^2), clamped to [0, 1]."""
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * j * j * lam * lam))
    q = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(2.0) * terms))
    return F.when(lam < KS_SMALL_LAMBDA, F.lit(1.0)).otherwise(q)


def exact_ks_p(m: int, n: int, gap: int) -> float:
    """P(D >= gap / (m n)) for samples of ``m`` and ``n`` values without ties.

    Merging the samples in value order is a walk on a lattice: after i values
    of one and j of the other the ECDF gap is |i n - j m| / (m n), and the
    next value is from the first sample with probability (m - i) / (values
    left).  Step by step, what reaches ``gap`` leaves the walk and adds up to
    the p-value; all terms are positive, so small p-values keep their digits.
    O((m + n) min(m, n)) steps of a vector."""
    if gap <= 0:
        return 1.0
    m, n = min(m, n), max(m, n)
    i = np.arange(m + 1)
    inside, outside = np.zeros(m + 1), 0.0
    inside[0] = 1.0
    for t in range(m + n):
        left = m + n - t
        first = inside * ((m - i) / left)
        inside = inside * ((n - t + i) / left)
        inside[1:] += first[:-1]
        # places with |i n - j m| < gap, j = t + 1 - i, are one run of i
        lo = max(0, ((t + 1) * m - gap) // (m + n) + 1)
        hi = min(m, -((-(t + 1) * m - gap) // (m + n)) - 1)
        outside += inside[:lo].sum() + inside[hi + 1:].sum()
        inside[:lo] = 0.0
        inside[hi + 1:] = 0.0
    return min(1.0, outside)


def _exact_column(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Appends the exact p-value to rows with a ``_gap``; others get null."""
    for b in batches:
        m, n, gap = (b.column(c).to_pylist() for c in ("n_ref", "n_cur", "_gap"))
        p = [None if g is None else exact_ks_p(x, y, g) for x, y, g in zip(m, n, gap)]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())], names=[*b.schema.names, "_exact"])


def ks_two_sample(values: DataFrame, sample_col: str = "sample", value_col: str = "value",
                  ref: str = "reference", cur: str = "current", by=(), exact_max: int = KS_EXACT_MAX) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and p-value per ``by``
    key, from a long table of (sample, value).  Output: n_ref, n_cur,
    ks_stat, p_value (null when a sample is empty - X4).  The p-value is
    exact if neither sample is larger than ``exact_max``, else asymptotic."""
    by = list(by)
    whole = not by
    if whole:  # one group: the same grouped plan with a constant key
        values, by = values.withColumn("_all", F.lit(0)), ["_all"]
    counts = values.groupBy(*by, F.col(value_col).cast("double").alias("v")).agg(
        F.sum(F.when(F.col(sample_col) == ref, 1).otherwise(0)).cast("long").alias("a"),
        F.sum(F.when(F.col(sample_col) == cur, 1).otherwise(0)).cast("long").alias("b"))
    counts = materialize(counts, "value-counts")  # the samples are read once
    cum = running_sum(counts, "v", ["a", "b"], by=by, prefix="c_", inclusive=True, copy=False)
    tot = counts.groupBy(*by).agg(F.sum("a").alias("n_ref"), F.sum("b").alias("n_cur"))
    # one row per group; with no grouping it is exactly one row, so it is
    # broadcast rather than shuffling every value onto the constant key
    j = cum.join(F.broadcast(tot) if whole else tot, by)
    gap = F.abs(F.try_divide("c_a", "n_ref") - F.try_divide("c_b", "n_cur"))
    small = (F.greatest("n_ref", "n_cur") <= exact_max) & (F.least("n_ref", "n_cur") > 0)
    # the same gap in whole numbers, where it has an exact p-value
    whole_gap = F.when(small, F.abs(F.col("c_a") * F.col("n_cur") - F.col("c_b") * F.col("n_ref")))
    d = j.groupBy(*by, "n_ref", "n_cur").agg(F.max(gap).alias("ks_stat"), F.max(whole_gap).alias("_gap"))
    schema = T.StructType([*d.schema.fields, T.StructField("_exact", T.DoubleType())])
    d = d.mapInArrow(_exact_column, schema)
    en = F.sqrt(F.col("n_ref") * F.col("n_cur") / (F.col("n_ref") + F.col("n_cur")).cast("double"))
    p = F.coalesce(F.col("_exact"), F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0),
                                           kolmogorov_sf(en * F.col("ks_stat"))))
    out = d.select(*by, "n_ref", "n_cur", F.when(F.col("n_ref") * F.col("n_cur") > 0, F.col("ks_stat"))
                   .alias("ks_stat"), p.alias("p_value"))
    return out.drop("_all") if whole else out


def drift_decision(p_value: Column, threshold: float = P_THRESHOLD, invert: bool = False) -> Column:
    """Drift when p < threshold.  ``invert=True`` reproduces the
    published rule (p > threshold)."""
    return (p_value > threshold) if invert else (p_value < threshold)


def frequency_drift(saved: DataFrame | None, new: DataFrame, threshold: float = P_THRESHOLD,
                    invert: bool = False) -> DataFrame:
    """X1 + X2 + X4: compare the Frequency values of a saved word-statistics
    table with new ones.  ``saved=None`` (no baseline) gives a row with a
    null statistic and no drift."""
    if saved is None:
        n_cur = new.select(F.count(F.lit(1))).scalar()
        return new.sparkSession.range(1).select(
            F.lit(0).cast("long").alias("n_ref"), n_cur.alias("n_cur"),
            F.lit(None).cast("double").alias("ks_stat"), F.lit(None).cast("double").alias("p_value"),
            F.lit(False).alias("drift_detected"))
    vals = (saved.select(F.lit("reference").alias("sample"), F.col("Frequency").alias("value"))
            .unionByName(new.select(F.lit("current").alias("sample"), F.col("Frequency").alias("value"))))
    ks = ks_two_sample(vals)
    return ks.withColumn("drift_detected", F.coalesce(drift_decision(F.col("p_value"), threshold, invert),
                                                      F.lit(False)))


def save_statistics(stats: DataFrame, base_path: str, run: str) -> int:
    """Replace the saved statistics by those of ``run``: the new files
    lie beside the ones being read and become the newest version by one
    atomic commit.  A run that is tried again makes no second version."""
    return write_run(stats, base_path, run)


def latest_statistics(spark, base_path: str) -> DataFrame:
    """The newest version that `save_statistics` committed; only its
    folder is read."""
    return read_latest(spark, base_path)


def text_descriptors(df: DataFrame, text_col: str, vocab: DataFrame, id_col: str) -> DataFrame:
    """X5 descriptors per text: length, share of non-letter characters,
    share of tokens not in ``vocab`` (Feature column).  The OOV share joins
    the exploded tokens to the vocabulary (no broadcast assumption)."""
    t = F.col(text_col)
    base = df.filter(t.isNotNull()).select(
        id_col, F.length(t).cast("double").alias("text_length"),
        F.when(F.length(t) > 0, F.length(F.regexp_replace(t, r"\p{L}", "")) / F.length(t))
         .otherwise(F.lit(0.0)).alias("non_letter_share"), t.alias("_t"))
    toks = base.select(id_col, F.explode(word_tokens("_t")).alias("Feature"))
    v = vocab.select("Feature").distinct().withColumn("_in", F.lit(1))
    oov = toks.join(v, "Feature", "left").groupBy(id_col).agg(
        (F.sum(F.when(F.col("_in").isNull(), 1).otherwise(0)) / F.count(F.lit(1))).alias("oov_share"))
    return base.drop("_t").join(oov, id_col, "left").withColumn(
        "oov_share", F.coalesce(F.col("oov_share"), F.lit(0.0)))


DESCRIPTORS = ["text_length", "non_letter_share", "oov_share"]


def descriptor_drift(reference: DataFrame, current: DataFrame, text_col: str, vocab: DataFrame,
                     id_col: str, threshold: float = P_THRESHOLD) -> DataFrame:
    """X5 + X7: KS per descriptor between two text samples; one row per
    descriptor (stat, p, drifted) plus a `dataset` row that is drifted when
    any descriptor is."""
    def long(d, name):
        x = text_descriptors(d, text_col, vocab, id_col)
        return x.unpivot([id_col], DESCRIPTORS, "descriptor", "value").withColumn("sample", F.lit(name))
    vals = long(reference, "reference").unionByName(long(current, "current"))
    ks = ks_two_sample(vals, by=["descriptor"])
    ks = ks.withColumn("drifted", F.coalesce(F.col("p_value") < threshold, F.lit(False)))
    summary = ks.agg(F.lit("dataset").alias("descriptor"), F.min("n_ref").alias("n_ref"),
                     F.min("n_cur").alias("n_cur"), F.lit(None).cast("double").alias("ks_stat"),
                     F.min("p_value").alias("p_value"), F.max(F.col("drifted").cast("int")).cast("boolean")
                     .alias("drifted"))
    return ks.unionByName(summary)


def drift_counter(events: DataFrame, key: str, order_ts: str, tiebreak: str,
                  reset_at: int = 10) -> DataFrame:
    """X6 (batch): counter value after each drift event of a key, and
    whether the event triggers retraining.  Event k (1-based) of a key
    stores (k - 1) mod reset_at and triggers when k > 1 and that is 0 -
    from an empty table the first trigger is event reset_at + 1."""
    e = events.withColumn("_t", F.unix_micros(F.col(order_ts).cast("timestamp")))
    r = rank_within(e, ["_t", tiebreak], by=[key], name="_k", copy=False).drop("_t")
    cnt = F.pmod(F.col("_k") - 1, F.lit(reset_at))
    return (r.withColumn("drift_counter", cnt.cast("int"))
             .withColumn("triggered", (F.col("_k") > 1) & (cnt == 0))
             .drop("_k"))


def latest_counter(counter_rows: DataFrame, key: str, ts: str = "inserted_datetime",
                   value: str = "drift_counter", tiebreak: str | None = None) -> DataFrame:
    """The most recent counter value per key (max_by, a partial
    aggregate - never a sort of the whole table)."""
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    return counter_rows.groupBy(key).agg(F.max_by(F.col(value), order).alias(value),
                                         F.max(ts).alias(ts))


CHI2_TERMS = 2000  # terms of the series; enough for every x below CHI2_LARGE
CHI2_LARGE = 700.0  # beyond it the survival function is 0 to double precision


def chi2_sf(x: Column, dof: Column) -> Column:
    """Chi-square survival function for any number of degrees of freedom:
    1 - P(dof/2, x/2) by the series of the regularised incomplete gamma
    function; 1 without a degree of freedom."""
    a, h = dof / F.lit(2.0), x / F.lit(2.0)
    # log Gamma(a + 1) for halves: sum of logs from a down to 1 or 1/2
    steps = F.sequence(F.lit(0), F.ceil(a).cast("int") - 1)
    log_gamma = F.aggregate(steps, F.lit(0.0), lambda s, k: s + F.log(a - k)) + \
        F.when(F.pmod(dof, F.lit(2)) == 1, F.lit(0.5 * math.log(math.pi))).otherwise(F.lit(0.0))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(CHI2_TERMS)),
                         F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
                         lambda acc, k: F.struct((acc["t"] * h / (a + k)).alias("t"),
                                                 (acc["s"] + acc["t"] * h / (a + k)).alias("s")),
                         lambda acc: acc["s"])
    p = F.exp(a * F.log(h) - h - log_gamma) * series
    return (F.when(dof < 1, F.lit(1.0)).when(h <= 0, F.lit(1.0)).when(h - a > CHI2_LARGE, F.lit(0.0))
             .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(1.0) - p))))


def label_drift(reference: DataFrame, current: DataFrame, label: str,
                threshold: float = P_THRESHOLD) -> DataFrame:
    """Chi-square test of homogeneity between the label histograms of
    two samples (one row: chi2, dof, p_value, drifted).  Every label counts,
    null too; labels that neither sample has are no degree of freedom."""
    h = (reference.select(F.col(label).alias("_l"), F.lit(1).alias("_r"), F.lit(0).alias("_c"))
         .unionByName(current.select(F.col(label).alias("_l"), F.lit(0).alias("_r"), F.lit(1).alias("_c")))
         .groupBy("_l").agg(F.sum("_r").cast("double").alias("o_r"), F.sum("_c").cast("double").alias("o_c")))
    w = Window.partitionBy()  # over the histogram: one row per label
    j = h.withColumn("nr", F.sum("o_r").over(w)).withColumn("nc", F.sum("o_c").over(w))
    n = F.col("nr") + F.col("nc")
    er = (F.col("o_r") + F.col("o_c")) * F.col("nr") / n
    ec = (F.col("o_r") + F.col("o_c")) * F.col("nc") / n
    term = F.when(er > 0, F.pow(F.col("o_r") - er, 2) / er).otherwise(0.0) + \
        F.when(ec > 0, F.pow(F.col("o_c") - ec, 2) / ec).otherwise(0.0)
    res = j.agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("chi2"),
                F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).cast("int").alias("dof"))
    return res.select("chi2", "dof", chi2_sf(F.col("chi2"), F.col("dof")).alias("p_value")).withColumn(
        "drifted", F.col("p_value") < threshold)
