"""Invariants of SURVEY §5 on the driver tables (sf0.01)."""

import pytest
from pyspark.sql import functions as F

from revlens.operators import clean as C
from revlens.operators import dashboard as D
from revlens.operators import metrics as MT
from revlens.operators import quality as Q
from revlens.operators import sampling as M
from revlens.plans.q_metrics import _preds
from revlens.sources import testdata as td

SF = "/root/testdata/sf0.01"


def test_confusion_sums_to_n(spark):
    p = _preds(spark, SF)
    conf = MT.confusion(p)
    tot = {r.Model_Name: r.n for r in conf.groupBy("Model_Name").agg(F.sum("count").alias("n")).collect()}
    n = td.eval_labels(spark, SF).count()
    assert set(tot.values()) == {n}


def test_percentages_sum_to_100(spark):
    star = (td.review_facts(spark, SF), td.products(spark, SF), td.categories(spark, SF))
    j = (D.positive_percentage(*star).join(D.neutral_percentage(*star), "category_name")
         .join(D.negative_percentage(*star), "category_name"))
    for r in j.collect():
        assert abs(r.positive_percentage + r.neutral_percentage + r.negative_percentage - 100.0) < 1e-9


def test_oversample_reaches_category_max(spark):
    d = td.labeled_facts(spark, SF).select("row_id", "main_category", "label")
    out = M.oversample(d)
    mx = {r.main_category: r.max_label_count for r in M.max_label_count(d).collect()}
    for r in out.groupBy("main_category", "label").count().collect():
        assert r["count"] == mx[r.main_category]


def test_capped_sample_sizes(spark):
    d = td.labeled_facts(spark, SF)
    sizes = {r.main_category: r["count"] for r in d.groupBy("main_category").count().collect()}
    got = {r.main_category: r["count"] for r in M.capped_sample(d, "main_category", 30).groupBy("main_category").count().collect()}
    assert got == {k: min(30, v) for k, v in sizes.items()}


def test_validation_split_exact(spark):
    d = td.labeled_facts(spark, SF).select("row_id")
    n = d.count()
    s = M.train_validation_split(d)
    import math
    assert s.filter("split = 'validation'").count() == math.ceil(0.2 * n)
    assert s.count() == n


def test_require_columns():
    class _D:
        columns = ["a", "b"]
    assert Q.require_columns(_D(), "a") is not None
    with pytest.raises(ValueError):
        Q.require_columns(_D(), "a", "c")


def test_blank_filter(spark):
    df = spark.createDataFrame([("  ",), ("\t\n",), (" x ",), (None,), ("",)], "text string")
    assert [r.text for r in C.drop_blank(df).collect()] == [" x "]


def test_schema_report(spark):
    from revlens.sources import schemas as S
    r = {x.column: x.actual for x in Q.schema_report(td.raw_reviews(spark, SF), S.REVIEWS).collect()}
    assert r["images"] == "Column not found"
    assert "rating" not in r  # declared type matches


def test_blank_matches_python_strip(spark):
    # Python's strip() also removes Unicode spaces and the \x1c-\x1f separators
    texts = [" ", "\u00a0", "\u3000\t", "\x1c\x1f", "\u200b", "x", "\u2028y", "\x0b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.text for r in C.drop_blank(df).collect()]
    assert sorted(got) == sorted(t for t in texts if t.strip() != "")
