"""Registered evaluation / fairness / ranking queries (E1, E4-E17, A13-A15,
P16-P18) over labels joined to documents, scored by the stand-in models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as LB
from ..operators import metrics as MT
from ..operators import scoring as SC
from ..session import materialize
from ..sources import testdata as td
from .catalog import register
from .sqltext import tokens_sql
from .sqlviews import with_views

R = MT.METRIC_ROUND


def _preds(spark, sf, models=tuple(td.MODELS)):
    return td.predictions(spark, sf, models)


def _stored_preds(spark, sf):
    """Predictions written once: every metric branch reads the same table."""
    return materialize(_preds(spark, sf))


def _preds_sql() -> dict[str, str]:
    parts = []
    for name in td.MODELS:
        s = td.predictions_sql(name)
        parts.append(f"SELECT '{name}' AS Model_Name, doc_id, main_category, store, label, "
                     f"{s[0]} AS s0, {s[1]} AS s1, {s[2]} AS s2 FROM eval_labels_v")
    return {
        "preds0": "\n  UNION ALL ".join(parts),
        "preds": """SELECT *, s0 / (s0 + s1 + s2) AS p0, s1 / (s0 + s1 + s2) AS p1, s2 / (s0 + s1 + s2) AS p2,
    CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS prediction FROM preds0""",
    }


def _per_class_sql(keys: str) -> dict[str, str]:
    k = keys + ", " if keys else ""
    on = " AND ".join([f"t.{c.strip()} = p.{c.strip()}" for c in keys.split(",") if c.strip()] + ["t.class = p.class"])
    on2 = " AND ".join([f"x.{c.strip()} = tp.{c.strip()}" for c in keys.split(",") if c.strip()] + ["x.class = tp.class"])
    co = ", ".join(f"coalesce(t.{c.strip()}, p.{c.strip()}) AS {c.strip()}" for c in keys.split(",") if c.strip())
    return {
        "conf": f"SELECT {k}label, prediction, COUNT(*) AS count FROM preds GROUP BY {k}label, prediction",
        "t": f"SELECT {k}label AS class, CAST(SUM(count) AS BIGINT) AS support FROM conf GROUP BY {k}label",
        "p": f"SELECT {k}prediction AS class, CAST(SUM(count) AS BIGINT) AS predicted FROM conf GROUP BY {k}prediction",
        "tp": f"SELECT {k}label AS class, CAST(SUM(count) AS BIGINT) AS tp FROM conf WHERE label = prediction "
              f"GROUP BY {k}label",
        "x": f"SELECT {co}, coalesce(t.class, p.class) AS class, coalesce(t.support, 0) AS support, "
             f"coalesce(p.predicted, 0) AS predicted FROM t FULL JOIN p ON {on}",
        "pc0": f"SELECT x.*, coalesce(tp.tp, 0) AS tp FROM x LEFT JOIN tp ON {on2}",
        "pc1": """SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM pc0""",
        "pc": """SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
    ELSE 0.0 END AS f1_score FROM pc1""",
    }


def _summary_sql(keys: str, average: str) -> str:
    if average == "weighted":
        def avg(m):
            return f"SUM({m} * support) / SUM(support)"
    else:
        def avg(m):
            return f"AVG({m})"
    return (f"SELECT {keys}, round(SUM(tp) / SUM(support), {R}) AS accuracy, round({avg('precision')}, {R}) "
            f"AS precision, round({avg('recall')}, {R}) AS recall, round({avg('f1_score')}, {R}) AS f1_score "
            f"FROM pc GROUP BY {keys}")


def _ev(body, keys="Model_Name", extra=None):
    return with_views(body, "eval_labels_v", extra={**_preds_sql(), **_per_class_sql(keys), **(extra or {})})


_E1_CTES = {
    "words": f"""SELECT doc_id, label, ('0x' || substr(md5(unnest({tokens_sql('text')})), 1, 4))::INT AS bucket
  FROM documents JOIN eval_labels_v USING (doc_id)""",
    "counts": """SELECT bucket, count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1,
    count(*) FILTER (label = 2) AS n2 FROM words WHERE doc_id % 5 <> 0 GROUP BY bucket""",
    "totals": """SELECT coalesce(sum(n0), 0) + 655.36::DOUBLE AS t0, coalesce(sum(n1), 0) + 655.36::DOUBLE AS t1,
    coalesce(sum(n2), 0) + 655.36::DOUBLE AS t2 FROM counts""",
    "weights": """SELECT w.bucket, round(ln((coalesce(n0, 0) + 0.01::DOUBLE) / t0) * 1e6)::BIGINT AS w0,
    round(ln((coalesce(n1, 0) + 0.01::DOUBLE) / t1) * 1e6)::BIGINT AS w1, round(ln((coalesce(n2, 0) + 0.01::DOUBLE) / t2) * 1e6)::BIGINT AS w2
  FROM (SELECT DISTINCT bucket FROM words) w LEFT JOIN counts USING (bucket), totals""",
    "shares": """SELECT round(ln((count(*) FILTER (label = 0) + 1) / (count(*) + 3)) * 1e6)::BIGINT AS w0,
    round(ln((count(*) FILTER (label = 1) + 1) / (count(*) + 3)) * 1e6)::BIGINT AS w1,
    round(ln((count(*) FILTER (label = 2) + 1) / (count(*) + 3)) * 1e6)::BIGINT AS w2
  FROM eval_labels_v JOIN documents USING (doc_id) WHERE doc_id % 5 <> 0 AND text IS NOT NULL""",
    "sums": """SELECT e.doc_id, s.w0 + coalesce(x.w0, 0) AS s0, s.w1 + coalesce(x.w1, 0) AS s1, s.w2 + coalesce(x.w2, 0) AS s2
  FROM eval_labels_v e CROSS JOIN shares s LEFT JOIN (SELECT doc_id, sum(w0) AS w0, sum(w1) AS w1, sum(w2) AS w2
    FROM words JOIN weights USING (bucket) GROUP BY doc_id) x USING (doc_id)""",
    "likely": """SELECT *, exp((s0 - greatest(s0, s1, s2)) / 1e6) AS e0, exp((s1 - greatest(s0, s1, s2)) / 1e6) AS e1,
    exp((s2 - greatest(s0, s1, s2)) / 1e6) AS e2 FROM sums""",
}


@register("e1_batch_scoring_arrow", with_views("""SELECT doc_id, 'naive_bayes' AS Model_Name,
  round(e0 / (e0 + e1 + e2), 9) AS p0, round(e1 / (e0 + e1 + e2), 9) AS p1, round(e2 / (e0 + e1 + e2), 9) AS p2,
  CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS prediction FROM likely""",
                                               "eval_labels_v", extra=_E1_CTES))
def e1(spark, sf):
    """Texts scored in Arrow batches by a model fitted on the labeled
    documents whose id is not divisible by 5; the scorer sees words only."""
    labeled = td.table(spark, sf, "documents").select("doc_id", "text").join(
        td.eval_labels(spark, sf).select("doc_id", "label"), "doc_id")
    weights = SC.fit_text_model(labeled.where(F.pmod("doc_id", F.lit(5)) != 0), "text", "label")
    out = SC.score_texts(labeled, weights, "naive_bayes")
    return out.select("doc_id", "Model_Name", *[F.round(F.col("probs")[k], 9).alias(f"p{k}") for k in range(3)],
                      "prediction")


@register("e4_confusion_matrix", _ev("SELECT Model_Name, label, prediction, count FROM conf"))
def e4(spark, sf):
    """Confusion counts per model."""
    return MT.confusion(_preds(spark, sf))


@register("e5_weighted_metrics", _ev(_summary_sql("Model_Name", "weighted")))
def e5(spark, sf):
    """E5: accuracy and weighted precision / recall / f1."""
    return MT.summary(MT.confusion(_preds(spark, sf)), ["Model_Name"], "weighted")


@register("e6_macro_metrics", _ev(_summary_sql("Model_Name", "macro")))
def e6(spark, sf):
    """Accuracy and macro precision / recall / f1."""
    return MT.summary(MT.confusion(_preds(spark, sf)), ["Model_Name"], "macro")


_MCC_SQL = f"""SELECT Model_Name, round(CASE WHEN den = 0 THEN 0.0 ELSE (c * s - pt) / den END, {R}) AS mcc FROM (
  SELECT Model_Name, c, s, pt, sqrt((s * s - pp) * (s * s - tt)) AS den FROM (
    SELECT Model_Name, CAST(SUM(tp) AS DOUBLE) AS c, CAST(SUM(support) AS DOUBLE) AS s,
           CAST(SUM(predicted * support) AS DOUBLE) AS pt, CAST(SUM(predicted * predicted) AS DOUBLE) AS pp,
           CAST(SUM(support * support) AS DOUBLE) AS tt FROM pc GROUP BY Model_Name) a) b"""


@register("e7_mcc", _ev(_MCC_SQL))
def e7(spark, sf):
    """Multiclass Matthews correlation per model."""
    return MT.mcc(MT.confusion(_preds(spark, sf)))


@register("e8_classification_report", _ev(f"""
SELECT Model_Name, CAST(class AS VARCHAR) AS row, round(precision, {R}) AS precision, round(recall, {R}) AS recall,
       round(f1_score, {R}) AS f1_score, support FROM pc
UNION ALL SELECT Model_Name, 'macro avg', round(AVG(precision), {R}), round(AVG(recall), {R}), round(AVG(f1_score), {R}),
       CAST(SUM(support) AS BIGINT) FROM pc GROUP BY Model_Name
UNION ALL SELECT Model_Name, 'weighted avg', round(SUM(precision * support) / SUM(support), {R}),
       round(SUM(recall * support) / SUM(support), {R}), round(SUM(f1_score * support) / SUM(support), {R}),
       CAST(SUM(support) AS BIGINT) FROM pc GROUP BY Model_Name"""))
def e8(spark, sf):
    """Classification report rows."""
    return MT.classification_report(MT.confusion(_preds(spark, sf)))


_AUC_CTES = {
    "ex": """SELECT Model_Name, label, 0 AS class, p0 AS score FROM preds
    UNION ALL SELECT Model_Name, label, 1, p1 FROM preds UNION ALL SELECT Model_Name, label, 2, p2 FROM preds""",
    "sagg": """SELECT Model_Name, class, score, SUM(CASE WHEN label = class THEN 1 ELSE 0 END) AS pos,
    SUM(CASE WHEN label <> class THEN 1 ELSE 0 END) AS neg FROM ex GROUP BY Model_Name, class, score""",
    "scum": """SELECT *, coalesce(SUM(neg) OVER (PARTITION BY Model_Name, class ORDER BY score
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM sagg""",
    "aucper": """SELECT Model_Name, class, SUM(pos * (below + neg / 2.0)) AS u, SUM(pos) AS P, SUM(neg) AS N
    FROM scum GROUP BY Model_Name, class""",
}
_AUC_SQL = f"""SELECT Model_Name, round(CASE WHEN SUM(CASE WHEN P > 0 THEN 1 ELSE 0 END) = 3
    THEN SUM(CASE WHEN P > 0 AND N > 0 THEN u / (P * N) END * P) / SUM(P) ELSE 0.0 END, {R}) AS auc
FROM aucper GROUP BY Model_Name"""


@register("e9_auc_ovr", _ev(_AUC_SQL, extra=_AUC_CTES))
def e9(spark, sf):
    """Weighted one-vs-rest ROC AUC per model."""
    return MT.auc_ovr(_preds(spark, sf))


_LL_SQL = f"""SELECT Model_Name, round(AVG(-ln(greatest(CASE label WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END,
  {MT.LOG_LOSS_EPS}))), {R}) AS log_loss FROM preds GROUP BY Model_Name"""


@register("e10_log_loss", _ev(_LL_SQL))
def e10(spark, sf):
    """Log loss per model."""
    return MT.log_loss(_preds(spark, sf))


_WIDE_CTES = {
    **_AUC_CTES,
    "w_sum": _summary_sql("Model_Name", "weighted"),
    "w_mcc": _MCC_SQL,
    "w_auc": _AUC_SQL,
    "w_ll": _LL_SQL,
    "wide": """SELECT s.Model_Name, s.accuracy, s.f1_score AS f1, s.precision, s.recall, a.auc, m.mcc, l.log_loss
    FROM w_sum s JOIN w_auc a ON s.Model_Name = a.Model_Name JOIN w_mcc m ON s.Model_Name = m.Model_Name
    JOIN w_ll l ON s.Model_Name = l.Model_Name""",
    "long": """UNPIVOT wide ON accuracy, f1, precision, recall, auc, mcc, log_loss INTO NAME Metric VALUE Value""",
}


@register("e11_metrics_long", _ev("SELECT Model_Name, Metric, CAST(Value AS DOUBLE) AS Value FROM long",
                                  extra=_WIDE_CTES))
def e11(spark, sf):
    """E11 + A15: all model metrics as (Model_Name, Metric, Value) rows."""
    return MT.to_long(MT.evaluate(_stored_preds(spark, sf)))


_RANK_W = {m: w / sum(MT.RANK_WEIGHTS.values()) for m, w in MT.RANK_WEIGHTS.items()}
_SCORE_SQL = " + ".join(f"{m} * {w!r}" for m, w in _RANK_W.items())


def _long2_sql():
    # a second appended evaluation run of model_a (other skill) -> duplicates
    return {"long_all": "SELECT Model_Name, Metric, CAST(Value AS DOUBLE) AS Value FROM long"}


@register("a13_mean_duplicate_metrics", _ev("""SELECT Model_Name, Metric, AVG(Value) AS Value FROM (
  SELECT * FROM long_all UNION ALL SELECT * FROM long_all WHERE Model_Name = 'model_a') t
GROUP BY Model_Name, Metric""", extra={**_WIDE_CTES, **_long2_sql()}))
def a13(spark, sf):
    """A13 + Q5: metric rows appended twice for one model, duplicates averaged."""
    long = MT.to_long(MT.evaluate(_stored_preds(spark, sf)))
    return MT.mean_duplicates(long.unionByName(long.filter(F.col("Model_Name") == "model_a")))


@register("e16_rank_models", _ev(f"""SELECT *, CAST(row_number() OVER (ORDER BY Score DESC, Model_Name) AS INTEGER)
  AS model_rank FROM (
  SELECT Model_Name, accuracy, f1, precision, recall, auc, mcc, log_loss, round({_SCORE_SQL}, {R}) AS Score FROM (
    PIVOT (SELECT Model_Name, Metric, AVG(Value) AS Value FROM long_all GROUP BY Model_Name, Metric)
    ON Metric IN ('accuracy', 'f1', 'precision', 'recall', 'auc', 'mcc', 'log_loss') USING first(Value)) p) q""",
                                 extra={**_WIDE_CTES, **_long2_sql()}))
def e16(spark, sf):
    """E16 + A14 + P4 + K5: weighted model ranking."""
    return MT.rank_models(MT.to_long(MT.evaluate(_stored_preds(spark, sf))))


_BG = "Model_Name, main_category"


@register("e12_metrics_by_group", _ev(_summary_sql(_BG, "weighted"), keys=_BG))
def e12(spark, sf):
    """Weighted metrics per (model, category)."""
    return MT.by_group(_preds(spark, sf), "main_category", "weighted")


@register("e13_macro_metrics_by_group", _ev(_summary_sql(_BG, "macro"), keys=_BG))
def e13(spark, sf):
    """Macro metrics per (model, category)."""
    return MT.by_group(_preds(spark, sf), "main_category", "macro")


@register("e14_demographic_parity", with_views(f"""SELECT Model_Name,
  round(MAX(r) - MIN(r), {R}) AS demographic_parity_difference,
  round(CASE WHEN MAX(r) = 0 THEN NULL ELSE MIN(r) / MAX(r) END, {R}) AS disparate_impact_ratio
FROM (SELECT Model_Name, main_category, AVG(CASE WHEN prediction = 1 THEN 1.0 ELSE 0.0 END) AS r
      FROM preds GROUP BY Model_Name, main_category) t GROUP BY Model_Name""",
    "eval_labels_v", extra=_preds_sql()))
def e14(spark, sf):
    """E14 + E17: demographic parity difference and disparate impact ratio."""
    return MT.demographic_parity(_preds(spark, sf), "main_category", 1)


@register("e15_group_metrics_long", _ev(f"""SELECT Model_Name,
  regexp_replace(main_category, '[^a-zA-Z0-9_:/-]', '_', 'g') AS Category, Metric, Value,
  regexp_replace(main_category, '[^a-zA-Z0-9_:/-]', '_', 'g') || '_' || Metric AS metric_key
FROM (UNPIVOT ({_summary_sql(_BG, 'weighted')}) ON accuracy, f1_score, precision, recall
      INTO NAME Metric VALUE Value) u""", keys=_BG))
def e15(spark, sf):
    """E15 + P11 + P20 + A15: by-group metrics as long rows."""
    return MT.by_group_long(_preds(spark, sf), "main_category", "weighted")


@register("p16_p18_score_functions", with_views(f"""SELECT doc_id,
  round(exp(l0 - m) / (exp(l0 - m) + exp(l1 - m) + exp(l2 - m)), {R}) AS softmax_0,
  CAST(CASE WHEN l0 >= l1 AND l0 >= l2 THEN 0 WHEN l1 >= l2 THEN 1 ELSE 2 END AS INTEGER) AS argmax,
  CASE WHEN l0 > l1 AND l0 > l2 THEN 'Positive' WHEN l1 > l0 AND l1 > l2 THEN 'Negative' ELSE 'Neutral' END
    AS strict_label
FROM (SELECT doc_id, l0, l1, l2, greatest(l0, l1, l2) AS m FROM (
  SELECT doc_id, CAST(n_chars % 3 AS DOUBLE) AS l0, CAST(doc_id % 3 AS DOUBLE) AS l1,
         CAST((doc_id + n_chars) % 3 AS DOUBLE) AS l2 FROM eval_labels_v) a) b""", "eval_labels_v"))
def p16(spark, sf):
    """P16 softmax, P17 argmax (first on ties), P18 strict argmax label."""
    b = td.eval_labels(spark, sf)
    logits = F.array(F.pmod("n_chars", F.lit(3)).cast("double"), F.pmod("doc_id", F.lit(3)).cast("double"),
                     F.pmod(F.col("doc_id") + F.col("n_chars"), F.lit(3)).cast("double"))
    return b.select("doc_id", logits.alias("v")).select(
        "doc_id", F.round(LB.softmax("v")[0], R).alias("softmax_0"), LB.argmax("v").alias("argmax"),
        LB.strict_argmax_label("v").alias("strict_label"))
