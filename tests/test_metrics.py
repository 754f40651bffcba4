"""Metric formulas against direct NumPy computations on small inputs."""

import numpy as np
from pyspark.sql import functions as F

from revlens.operators import drift as DR
from revlens.operators import metrics as MT


def _preds(spark, y, yhat, probs=None):
    probs = probs or [[1.0 if k == p else 0.0 for k in range(3)] for p in yhat]
    rows = [("m", int(a), int(b), [float(x) for x in pr], "g" + str(i % 2)) for i, (a, b, pr) in enumerate(zip(y, yhat, probs))]
    return spark.createDataFrame(rows, "Model_Name string, label int, prediction int, probs array<double>, main_category string")


def _np_metrics(y, yhat):
    y, yhat = np.array(y), np.array(yhat)
    classes = sorted(set(y) | set(yhat))
    p, r, f, s = [], [], [], []
    for c in classes:
        tp = np.sum((y == c) & (yhat == c))
        pp, tt = np.sum(yhat == c), np.sum(y == c)
        pr = tp / pp if pp else 0.0
        rc = tp / tt if tt else 0.0
        p.append(pr), r.append(rc), f.append(2 * pr * rc / (pr + rc) if pr + rc else 0.0), s.append(tt)
    s = np.array(s)
    w = lambda v: float(np.sum(np.array(v) * s) / np.sum(s))
    return {"accuracy": float(np.mean(y == yhat)), "wp": w(p), "wr": w(r), "wf": w(f),
            "mp": float(np.mean(p)), "mr": float(np.mean(r)), "mf": float(np.mean(f))}


def test_weighted_and_macro(spark):
    y = [0, 0, 1, 1, 2, 2, 2, 0, 1, 2]
    yhat = [0, 1, 1, 1, 2, 0, 2, 0, 2, 2]
    ref = _np_metrics(y, yhat)
    conf = MT.confusion(_preds(spark, y, yhat))
    w = MT.summary(conf, ["Model_Name"], "weighted").first()
    m = MT.summary(conf, ["Model_Name"], "macro").first()
    assert abs(w.accuracy - ref["accuracy"]) < 1e-9
    assert abs(w.precision - ref["wp"]) < 1e-9 and abs(w.recall - ref["wr"]) < 1e-9 and abs(w.f1_score - ref["wf"]) < 1e-9
    assert abs(m.precision - ref["mp"]) < 1e-9 and abs(m.recall - ref["mr"]) < 1e-9 and abs(m.f1_score - ref["mf"]) < 1e-9


def test_macro_uses_classes_of_slice(spark):
    # class 2 absent from both y and yhat: macro averages over {0, 1} only
    y, yhat = [0, 0, 1, 1], [0, 1, 1, 1]
    m = MT.summary(MT.confusion(_preds(spark, y, yhat)), ["Model_Name"], "macro").first()
    assert abs(m.recall - np.mean([0.5, 1.0])) < 1e-9


def test_mcc(spark):
    y = [0, 0, 1, 1, 2, 2, 2, 0, 1, 2]
    yhat = [0, 1, 1, 1, 2, 0, 2, 0, 2, 2]
    C = np.zeros((3, 3))
    for a, b in zip(y, yhat):
        C[a, b] += 1
    t, p, c, s = C.sum(1), C.sum(0), np.trace(C), C.sum()
    want = (c * s - t @ p) / np.sqrt((s * s - p @ p) * (s * s - t @ t))
    got = MT.mcc(MT.confusion(_preds(spark, y, yhat))).first().mcc
    assert abs(got - want) < 1e-9


def test_auc_brute_force(spark):
    rnd = np.random.default_rng(3)
    y = rnd.integers(0, 3, 60)
    raw = rnd.integers(1, 5, (60, 3)).astype(float)
    probs = (raw / raw.sum(1, keepdims=True)).tolist()
    got = MT.auc_ovr(_preds(spark, y, raw.argmax(1), probs)).first().auc
    aucs, wts = [], []
    P = np.array(probs)
    for k in range(3):
        pos, neg = P[y == k, k], P[y != k, k]
        u = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
        aucs.append(u / (len(pos) * len(neg)))
        wts.append(len(pos))
    want = float(np.dot(aucs, wts) / np.sum(wts))
    assert abs(got - want) < 1e-9


def test_auc_not_computable(spark):
    got = MT.auc_ovr(_preds(spark, [0, 0, 1], [0, 1, 1])).first().auc
    assert got == 0.0


def test_log_loss(spark):
    probs = [[0.7, 0.2, 0.1], [0.1, 0.8, 0.1], [0.3, 0.3, 0.4]]
    y = [0, 1, 2]
    got = MT.log_loss(_preds(spark, y, [0, 1, 2], probs)).first().log_loss
    want = -np.mean(np.log([0.7, 0.8, 0.4]))
    assert abs(got - want) < 1e-9


def test_demographic_parity(spark):
    p = _preds(spark, [0, 0, 0, 0], [1, 1, 1, 0])  # g0: rows 0,2 -> 1,1 ; g1: rows 1,3 -> 1,0
    r = MT.demographic_parity(p, "main_category", 1).first()
    assert abs(r.demographic_parity_difference - 0.5) < 1e-12 and abs(r.disparate_impact_ratio - 0.5) < 1e-12


def test_ks_statistic_brute_force(spark):
    rnd = np.random.default_rng(5)
    a, b = rnd.integers(0, 30, 200), rnd.integers(5, 40, 150)
    rows = [("reference", float(x)) for x in a] + [("current", float(x)) for x in b]
    got = DR.ks_two_sample(spark.createDataFrame(rows, "sample string, value double"), exact_max=0).first()
    grid = np.union1d(a, b)
    d = max(abs(np.mean(a <= g) - np.mean(b <= g)) for g in grid)
    assert abs(got.ks_stat - d) < 1e-12
    en = np.sqrt(len(a) * len(b) / (len(a) + len(b)))
    lam = en * d
    q = 2 * sum((-1) ** (j - 1) * np.exp(-2 * j * j * lam * lam) for j in range(1, 101))
    assert abs(got.p_value - min(1.0, max(0.0, q))) < 1e-9
