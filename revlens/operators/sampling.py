"""Sampling, splitting and balancing.

Randomness is a reproducible md5 order key (`ordering.shuffle_key`), not a
NumPy generator: membership can be recomputed by any engine with md5, and a
re-run after a lost executor draws the same rows.  Sample sizes, class
counts and failure rules follow the reference.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import hash_int, rank_by_shuffle_key, rank_within, shuffle_key, top_k_per_group


def _check_counts(df: DataFrame, by: str, need: int, what: str) -> DataFrame:
    """Fail inside the plan when a ``by`` group has fewer than ``need`` rows."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias("_have"))
    bad = counts.filter(F.col("_have") < need)
    return bad.select(F.raise_error(F.concat(F.lit(f"{what}: group "), F.col(by).cast("string"),
                                             F.lit(f" has fewer than {need} rows"))).alias("_err"))


def per_class_sample(df: DataFrame, label: str = "label", n: int = 100, seed: int = 42,
                     row_id: str = "row_id", strict: bool = True) -> DataFrame:
    """M1 (+K6, K7): ``n`` rows per class without replacement, then shuffled
    and renumbered 0..N-1 (``new_index``).  ``strict`` fails when a class
    has fewer than ``n`` rows (as the reference does)."""
    key = shuffle_key(row_id, seed)
    s = top_k_per_group(df, [label], [key, F.col(row_id)], n, name="_rn").drop("_rn")
    if strict:
        s = _guard(s, _check_counts(df, label, n, "per_class_sample"))
    return shuffle_renumber(s, row_id, seed=seed + 1)


def _guard(df: DataFrame, err: DataFrame) -> DataFrame:
    """Attach a failing check to ``df``: the scalar subquery raises if
    ``err`` has any row, otherwise it evaluates to 0 and changes nothing."""
    n_bad = err.select(F.count(F.col("_err")).alias("c")).scalar()
    return df.filter(n_bad == F.lit(0))


def shuffle_renumber(df: DataFrame, row_id: str = "row_id", seed: int = 42,
                     name: str = "new_index") -> DataFrame:
    """K6 + K7: random order (md5 key) and dense renumbering 0..N-1."""
    return rank_by_shuffle_key(df, row_id, seed, name=name).withColumn(name, F.col(name) - 1)


def capped_sample(df: DataFrame, by: str, cap: int = 30, seed: int = 42,
                  row_id: str = "row_id", null_group: str | None = "drop") -> DataFrame:
    """M2: min(cap, size) rows per group.  A null group selects nothing
    (``null_group='drop'``, the reference's behaviour) or is relabelled."""
    d = df
    if null_group == "drop":
        d = d.filter(F.col(by).isNotNull())
    elif null_group is not None:
        d = d.withColumn(by, F.coalesce(F.col(by), F.lit(null_group)))
    return top_k_per_group(d, [by], [shuffle_key(row_id, seed), F.col(row_id)], cap, name="_rn").drop("_rn")


def stratified_union(df: DataFrame, strata: list[str], k: int = 50, seed: int = 42,
                     row_id: str = "row_id", chunk_rows: int | None = 100_000) -> DataFrame:
    """M3 (+U1, U2): up to ``k`` rows per value of each stratum column (per
    ``chunk_rows`` chunk of row ids, as the chunked reader did), union of the
    samples, duplicates removed.  Each sample is a partial top-k, so a
    stratum with very many rows costs ``k`` rows per task."""
    key = [shuffle_key(row_id, seed), F.col(row_id)]
    parts = []
    for s in strata:
        by = [s] + (["_chunk"] if chunk_rows else [])
        d = df.withColumn("_chunk", F.floor(F.col(row_id) / chunk_rows)) if chunk_rows else df
        parts.append(top_k_per_group(d.filter(F.col(s).isNotNull()), by, key, k, name="_rn")
                     .drop("_rn", "_chunk"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.dropDuplicates()


#: Bins of the md5 order: 16 bits of the key.
_BIN_DIGITS = 4


def first_in_hash_order(df: DataFrame, wanted: DataFrame, by: list[str], seed: int, row_id: str) -> DataFrame:
    """The last row of each wanted prefix of the md5 order: for every
    (``by``, ``name``, ``n``) of ``wanted`` the key and id of the ``n``-th row
    of its group (``cut``).

    Only counts per (group, bin of the key) are cumulated; ranked are just
    the rows of the bins that hold a cut, one in 65 536 of a group."""
    keyed = df.select(*by, F.col(row_id).alias("_id"), shuffle_key(row_id, seed).alias("_key")) \
              .withColumn("_bin", F.substring("_key", 1, _BIN_DIGITS))
    bins = keyed.groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = bins.withColumn("_upto", F.sum("_n").over(w))
    hit = bins.join(wanted, by).filter((F.col("n") > F.col("_upto") - F.col("_n")) & (F.col("n") <= F.col("_upto")))
    hit = hit.select(*by, "_bin", "name", (F.col("n") - F.col("_upto") + F.col("_n")).alias("_need"))
    near = keyed.join(hit, [*by, "_bin"])
    rank = F.row_number().over(Window.partitionBy(*by, "name").orderBy("_key", "_id"))
    return (near.withColumn("_rank", rank).filter(F.col("_rank") == F.col("_need"))
                .select(*by, "name", F.struct(F.col("_key").alias("k"), F.col("_id").alias("i")).alias("cut")))


def three_way_split(df: DataFrame, label: str = "label", n_classes: int = 3,
                    train_total: int = 20000, test_fraction: float = 0.2, seed: int = 42,
                    row_id: str = "row_id") -> DataFrame:
    """M4 (+J3, U3): add ``split`` in {train, test, inference}.

    train = ``train_total // n_classes`` rows per class; test =
    int(test_fraction * remaining / n_classes) rows per class from the rest;
    inference = everything else.  The two cuts of each class are found from
    counts; each row then compares itself with its class's cuts, so the rows
    are never shuffled.  Fails when a class is too small.
    """
    per_class = train_total // n_classes
    total = df.select(F.count(F.lit(1))).scalar()
    test_n = F.floor(F.lit(test_fraction) * (total - F.lit(per_class * n_classes)) / F.lit(n_classes))
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_have"))
    err = counts.filter(F.col("_have") < F.lit(per_class) + test_n).select(
        F.raise_error(F.concat(F.lit("three_way_split: class "), F.col(label).cast("string"),
                               F.lit(" is too small"))).alias("_err"))
    sizes = counts.filter(F.col(label).isNotNull()).withColumn("_test", test_n)
    wanted = sizes.select(label, F.inline(F.array(
        F.struct(F.lit("train").alias("name"), F.lit(per_class).cast("long").alias("n")),
        F.struct(F.lit("test").alias("name"), (F.lit(per_class) + F.col("_test")).cast("long").alias("n")))))
    cuts = first_in_hash_order(df, wanted, [label], seed, row_id)
    cuts = cuts.groupBy(label).agg(*[F.max(F.when(F.col("name") == s, F.col("cut"))).alias(f"_{s}")
                                     for s in ("train", "test")])
    here = F.struct(shuffle_key(row_id, seed).alias("k"), F.col(row_id).alias("i"))
    split = (F.when(here <= F.col("_train"), "train").when(here <= F.col("_test"), "test").otherwise("inference"))
    # one row per class: the label's domain is the model's class list
    out = df.join(F.broadcast(cuts), label, "left").withColumn("split", split).drop("_train", "_test")
    return _guard(out, err)


def _prefix(df: DataFrame, n, seed: int, row_id: str):
    """(cut, here): the key of the ``n``-th row in md5 order as a scalar
    subquery (null if there are fewer or ``n`` is 0), and a row's own key."""
    wanted = df.sparkSession.range(1).select(F.lit(0).alias("_all"), F.lit("all").alias("name"),
                                             n.cast("long").alias("n"))
    cut = first_in_hash_order(df.withColumn("_all", F.lit(0)), wanted, ["_all"], seed, row_id)
    return (cut.select(F.max("cut")).scalar(),
            F.struct(shuffle_key(row_id, seed).alias("k"), F.col(row_id).alias("i")))


def random_rows(df: DataFrame, n: int = 10000, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """M5: the first ``n`` rows in md5 order (all rows if there are fewer).
    Each row compares its key with the ``n``-th key, so nothing is gathered
    however large ``n`` is."""
    cut, here = _prefix(df, F.lit(n), seed, row_id)
    total = df.select(F.count(F.lit(1))).scalar()
    return df.filter((here <= cut) | (total <= F.lit(n))) if n > 0 else df.limit(0)


def train_validation_split(df: DataFrame, test_size: float = 0.2, seed: int = 42,
                           row_id: str = "row_id", exact: bool = True) -> DataFrame:
    """M6: ``split`` in {train, validation}.  ``exact``: validation is the
    ceil(test_size * n) rows first in md5 order; otherwise a hash threshold
    (no counting at all)."""
    if not exact:
        u = hash_int(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string"))).cast("double") / float(1 << 60)
        return df.withColumn("split", F.when(u < test_size, "validation").otherwise("train"))
    n_val = F.ceil(F.lit(test_size) * df.select(F.count(F.lit(1))).scalar())
    cut, here = _prefix(df, n_val, seed, row_id)
    return df.withColumn("split", F.when(here <= cut, "validation").otherwise("train"))


def max_label_count(df: DataFrame, by: str = "main_category", label: str = "label") -> DataFrame:
    """The largest label count inside each group."""
    return (df.groupBy(by, label).agg(F.count(F.lit(1)).alias("_n"))
              .groupBy(by).agg(F.max("_n").alias("max_label_count")))


def oversample(df: DataFrame, by: str = "main_category", label: str = "label", seed: int = 42,
               row_id: str = "row_id", chunk: int = 10_000) -> DataFrame:
    """M8: within each ``by`` group, draw every label smaller than the
    group's largest one with replacement up to that size; the largest labels
    pass unchanged.  Output adds ``slot`` (1..target; null for pass-through).

    Draws are slots: slot s of (group, label) takes the row ranked
    1 + md5(seed:group:label:s) mod n in that (group, label).  Slots are
    generated in chunks of ``chunk`` from a table with one row per
    (group, label) - nothing is collected - and matched to rows by an equi
    join on (group, label, rank).

    The chunk rows are spread over a fixed number of partitions (adaptive
    execution may not fold the tiny chunk table into one task, which would
    then generate every slot), and the join is a sort-merge join: the size
    of the generated slots is unknown to the planner, so it must never be
    chosen as a broadcast side.
    """
    cnt = df.groupBy(by, label).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(by)
    tgt = cnt.withColumn("_target", F.max("_n").over(w))
    keep = df.join(tgt.filter(F.col("_n") == F.col("_target")).select(by, label), [by, label], "left_semi")
    keep = keep.withColumn("slot", F.lit(None).cast("long"))
    short = tgt.filter(F.col("_n") < F.col("_target"))
    chunks = short.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_target") - 1) / chunk).cast("long"))))
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = (chunks.repartition(n_parts, by, label, "_c")
             .withColumn("slot", F.explode(F.sequence(F.col("_c") * chunk + 1,
                                                      F.least(F.col("_target").cast("long"), (F.col("_c") + 1) * chunk))))
             .select(by, label, "_n", "slot"))
    draw_key = F.concat_ws(":", F.lit(str(seed)), F.col(by).cast("string"), F.col(label).cast("string"),
                           F.col("slot").cast("string"))
    slots = slots.withColumn("_rn", F.lit(1) + F.pmod(hash_int(draw_key), F.col("_n"))).drop("_n")
    ranked = rank_within(df.join(short.select(by, label), [by, label], "left_semi"),
                         [row_id], by=[by, label], name="_rn")
    drawn = ranked.join(slots.hint("merge"), [by, label, "_rn"]).drop("_rn")
    return keep.unionByName(drawn)


def group_weights(df: DataFrame, by: str = "main_category") -> DataFrame:
    """M9: weight of each group = total rows / rows of the group."""
    c = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    tot = c.select(F.sum("n")).scalar()  # scalar subquery: no single-partition step
    return c.withColumn("sample_weight", tot.cast("double") / F.col("n").cast("double"))


def add_group_weights(df: DataFrame, by: str = "main_category") -> DataFrame:
    """M9 per row: join the group weights back (one row per group)."""
    return df.join(group_weights(df, by).select(by, "sample_weight"), by)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights n / (k * n_class)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()  # one row per class
    return c.withColumn("class_weight", F.sum("n").over(w).cast("double")
                        / (F.count(F.lit(1)).over(w).cast("double") * F.col("n").cast("double")))


def position_slices(df: DataFrame, slices: dict[str, tuple[int, int]], row_id: str = "row_id") -> DataFrame:
    """K4: rows whose dense position falls in [a, b) per named slice."""
    cond = None
    name = None
    for nm, (a, b) in slices.items():
        c = (F.col(row_id) >= a) & (F.col(row_id) < b)
        name = F.when(c, F.lit(nm)) if name is None else name.when(c, F.lit(nm))
        cond = c if cond is None else (cond | c)
    return df.filter(cond).withColumn("slice", name)


def first_seen(df: DataFrame, col: str, row_id: str = "row_id") -> DataFrame:
    """Distinct values in first-appearance order (``first_seen_rank``)."""
    firsts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.min(row_id).alias("first_row_id"))
    return rank_within(firsts, ["first_row_id"], name="first_seen_rank")


def remove_rows(df: DataFrame, other: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Rows of ``df`` whose id is not in ``other``."""
    return df.join(other.select(row_id), row_id, "left_anti")


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct over all columns (null equals null)."""
    return df.dropDuplicates()
