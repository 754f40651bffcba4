"""Classification metrics, fairness and model ranking.

Every count metric derives from the confusion table: one grouped aggregate
over the predictions (partial aggregation, so the shuffle carries at most
9 rows per key and task).  Everything after that runs on that tiny table.
AUC needs the score distribution: predictions are first aggregated by
distinct score, then cumulated with the bucketed running sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import metric_safe
from .ordering import running_sum

LOG_LOSS_EPS = 1e-15
METRIC_ROUND = 10  # digits kept in reported metric values


def confusion(preds: DataFrame, keys=("Model_Name",), label: str = "label",
              prediction: str = "prediction") -> DataFrame:
    """Counts per (keys, label, prediction)."""
    return preds.groupBy(*keys, label, prediction).agg(F.count(F.lit(1)).alias("count"))


def per_class(conf: DataFrame, keys=("Model_Name",), label: str = "label",
              prediction: str = "prediction") -> DataFrame:
    """E8 rows: precision, recall, f1, support for every class present in
    the true or predicted labels of each key (zero division -> 0).  Each
    confusion cell contributes to its true class (support, tp) and to its
    predicted class (predicted): one aggregation, no joins."""
    keys = list(keys)
    c = F.col("count")
    contrib = F.explode(F.array(
        F.struct(F.col(label).alias("class"), c.alias("support"),
                 F.when(F.col(label) == F.col(prediction), c).otherwise(F.lit(0)).alias("tp"),
                 F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col(prediction).alias("class"), F.lit(0).cast("long").alias("support"),
                 F.lit(0).cast("long").alias("tp"), c.alias("predicted"))))
    pc = (conf.select(*keys, contrib.alias("_c")).select(*keys, "_c.*")
              .groupBy(*keys, "class").agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
                                           F.sum("predicted").alias("predicted")))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    pc = pc.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return pc.withColumn("f1_score", f1)


def _r(c):
    return F.round(c, METRIC_ROUND)


def summary(conf: DataFrame, keys=("Model_Name",), average: str = "weighted") -> DataFrame:
    """Accuracy and averaged precision, recall, f1 per key."""
    keys = list(keys)
    pc = per_class(conf, keys)
    if average == "weighted":
        def avg(m):
            return F.sum(F.col(m) * F.col("support")) / F.sum("support")
    elif average == "macro":
        def avg(m):
            return F.avg(m)
    else:
        raise ValueError(average)
    return pc.groupBy(*keys).agg(
        _r(F.sum("tp") / F.sum("support")).alias("accuracy"),
        _r(avg("precision")).alias("precision"),
        _r(avg("recall")).alias("recall"),
        _r(avg("f1_score")).alias("f1_score"))


def classification_report(conf: DataFrame, keys=("Model_Name",)) -> DataFrame:
    """Per-class rows plus `macro avg` and `weighted avg` rows."""
    keys = list(keys)
    pc = per_class(conf, keys)
    rows = pc.select(*keys, F.col("class").cast("string").alias("row"), _r(F.col("precision")).alias("precision"),
                     _r(F.col("recall")).alias("recall"), _r(F.col("f1_score")).alias("f1_score"),
                     F.col("support").cast("long").alias("support"))
    macro = pc.groupBy(*keys).agg(F.lit("macro avg").alias("row"), _r(F.avg("precision")).alias("precision"),
                                  _r(F.avg("recall")).alias("recall"), _r(F.avg("f1_score")).alias("f1_score"),
                                  F.sum("support").cast("long").alias("support"))
    wsum = F.sum("support")
    weighted = pc.groupBy(*keys).agg(
        F.lit("weighted avg").alias("row"),
        _r(F.sum(F.col("precision") * F.col("support")) / wsum).alias("precision"),
        _r(F.sum(F.col("recall") * F.col("support")) / wsum).alias("recall"),
        _r(F.sum(F.col("f1_score") * F.col("support")) / wsum).alias("f1_score"),
        wsum.cast("long").alias("support"))
    return rows.unionByName(macro).unionByName(weighted)


def mcc(conf: DataFrame, keys=("Model_Name",)) -> DataFrame:
    """Multiclass Matthews correlation (0 when undefined)."""
    keys = list(keys)
    pc = per_class(conf, keys)
    g = pc.groupBy(*keys).agg(
        F.sum("tp").cast("double").alias("c"), F.sum("support").cast("double").alias("s"),
        F.sum(F.col("predicted") * F.col("support")).cast("double").alias("pt"),
        F.sum(F.col("predicted") * F.col("predicted")).cast("double").alias("pp"),
        F.sum(F.col("support") * F.col("support")).cast("double").alias("tt"))
    den = F.sqrt((F.col("s") * F.col("s") - F.col("pp")) * (F.col("s") * F.col("s") - F.col("tt")))
    val = F.when(den == 0, F.lit(0.0)).otherwise((F.col("c") * F.col("s") - F.col("pt")) / den)
    return g.select(*keys, _r(val).alias("mcc"))


def log_loss(preds: DataFrame, keys=("Model_Name",), label: str = "label", probs: str = "probs") -> DataFrame:
    """Mean of -ln(p[true class]), probabilities clipped at 1e-15."""
    p = F.element_at(F.col(probs), F.col(label) + 1)
    return preds.groupBy(*keys).agg(
        _r(F.avg(-F.log(F.greatest(p, F.lit(LOG_LOSS_EPS))))).alias("log_loss"))


def auc_ovr(preds: DataFrame, keys=("Model_Name",), label: str = "label", probs: str = "probs",
            n_classes: int = 3) -> DataFrame:
    """One-vs-rest ROC AUC averaged with class prevalence weights; 0.0
    when a class is absent from the true labels (not computable).

    AUC_k = sum over score values v of pos(v) * (neg(< v) + neg(v) / 2) / (P N),
    ties counted half, from predictions aggregated by distinct score.
    """
    keys = list(keys)
    ex = preds.select(*keys, F.col(label).alias("_y"),
                      F.posexplode(F.col(probs)).alias("class", "score"))
    agg = ex.groupBy(*keys, "class", "score").agg(
        F.sum(F.when(F.col("_y") == F.col("class"), 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col("_y") != F.col("class"), 1).otherwise(0)).cast("long").alias("neg"))
    cum = running_sum(agg, "score", ["neg"], by=[*keys, "class"], prefix="below_")
    per = cum.groupBy(*keys, "class").agg(
        F.sum(F.col("pos") * (F.col("below_neg") + F.col("neg") / 2.0)).alias("_u"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    per = per.withColumn("auc_k", F.when((F.col("P") > 0) & (F.col("N") > 0),
                                         F.col("_u") / (F.col("P") * F.col("N"))))
    tot = per.groupBy(*keys).agg(
        F.sum(F.when(F.col("P") > 0, 1).otherwise(0)).alias("_present"),
        F.sum(F.col("auc_k") * F.col("P")).alias("_w"), F.sum("P").alias("_n"))
    val = F.when(F.col("_present") == n_classes, F.col("_w") / F.col("_n")).otherwise(F.lit(0.0))
    return tot.select(*keys, _r(val).alias("auc"))


def evaluate(preds: DataFrame, keys=("Model_Name",)) -> DataFrame:
    """E5 + E7 + E9 + E10 as one wide row per key."""
    keys = list(keys)
    conf = confusion(preds, keys)
    s = summary(conf, keys, "weighted").withColumnRenamed("f1_score", "f1")
    return (s.join(auc_ovr(preds, keys), keys).join(mcc(conf, keys), keys)
             .join(log_loss(preds, keys), keys))


METRIC_NAMES = ["accuracy", "f1", "precision", "recall", "auc", "mcc", "log_loss"]


def to_long(wide: DataFrame, keys=("Model_Name",), metrics=None,
            var: str = "Metric", value: str = "Value") -> DataFrame:
    """Wide metric columns to (keys..., Metric, Value) rows."""
    metrics = metrics or [m for m in METRIC_NAMES if m in wide.columns]
    return wide.select(*keys, *[F.col(m).cast("double") for m in metrics]).unpivot(
        list(keys), metrics, var, value)


def by_group(preds: DataFrame, group: str = "main_category", average: str = "weighted",
             model_col: str = "Model_Name") -> DataFrame:
    """Accuracy, f1, precision, recall per (model, group)."""
    keys = [model_col, group]
    return summary(confusion(preds, keys), keys, average)


def by_group_long(preds: DataFrame, group: str = "main_category", average: str = "weighted") -> DataFrame:
    """By-group metrics as (Model_Name, Category, Metric, Value, key)
    rows with a metric-safe category name and `{category}_{metric}` key."""
    w = by_group(preds, group, average)
    long = w.unpivot(["Model_Name", group], ["accuracy", "f1_score", "precision", "recall"], "Metric", "Value")
    cat = metric_safe(F.col(group))
    return long.select("Model_Name", cat.alias("Category"), "Metric", "Value",
                       F.concat_ws("_", cat, F.col("Metric")).alias("metric_key"))


def selection_rates(preds: DataFrame, group: str = "main_category", pos_label: int = 1,
                    model_col: str = "Model_Name") -> DataFrame:
    """Share of rows predicted ``pos_label`` per (model, group)."""
    return preds.groupBy(model_col, group).agg(
        F.avg(F.when(F.col("prediction") == pos_label, 1.0).otherwise(0.0)).alias("selection_rate"))


def demographic_parity(preds: DataFrame, group: str = "main_category", pos_label: int = 1,
                       model_col: str = "Model_Name") -> DataFrame:
    """E14 + E17: max - min selection rate over groups (parity difference)
    and min / max (disparate impact ratio, null when max is 0)."""
    r = selection_rates(preds, group, pos_label, model_col)
    return r.groupBy(model_col).agg(
        _r(F.max("selection_rate") - F.min("selection_rate")).alias("demographic_parity_difference"),
        _r(F.try_divide(F.min("selection_rate"), F.max("selection_rate"))).alias("disparate_impact_ratio"))


# --- fixed values -----------------------------------------------------------
# Model ranking weights (divided by their sum, 1.05, before use).
RANK_WEIGHTS = {"accuracy": 0.3, "f1": 0.3, "precision": 0.2, "recall": 0.2,
                "auc": 0.05, "mcc": 0.05, "log_loss": -0.05}
# ---------------------------------------------------------------------------


def mean_duplicates(long: DataFrame) -> DataFrame:
    """Mean Value of duplicate (Model_Name, Metric) rows."""
    return long.groupBy("Model_Name", "Metric").agg(F.avg("Value").alias("Value"))


def pivot_metrics(long: DataFrame, metrics=None) -> DataFrame:
    """A14 (+P4): (Model_Name, Metric, Value) -> one row per model with a
    column per metric (explicit list: no extra job), missing -> 0."""
    metrics = metrics or list(RANK_WEIGHTS)
    wide = long.groupBy("Model_Name").pivot("Metric", metrics).agg(F.first("Value"))
    return wide.na.fill(0.0, metrics)


def rank_models(*longs: DataFrame) -> DataFrame:
    """Union metric tables, average duplicates, pivot, fill 0, weighted
    score, sorted by score (model name breaks ties)."""
    u = longs[0]
    for x in longs[1:]:
        u = u.unionByName(x)
    wide = pivot_metrics(mean_duplicates(u))
    tot = sum(RANK_WEIGHTS.values())
    score = sum(F.col(m) * F.lit(w / tot) for m, w in RANK_WEIGHTS.items())
    w = Window.orderBy(F.desc("Score"), "Model_Name")  # one row per model
    return (wide.withColumn("Score", _r(score))
                .withColumn("model_rank", F.row_number().over(w))
                .orderBy("model_rank"))
