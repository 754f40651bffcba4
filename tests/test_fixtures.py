"""Edge cases of FIXTURES.md (behaviour read from the reference's code)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from revlens.functions import labels as LB
from revlens.functions import text as TX
from revlens.operators import clean as C
from revlens.operators import dashboard as D
from revlens.operators import drift as DR
from revlens.operators import labeling as L
from revlens.operators import metrics as MT
from revlens.operators import sampling as M
from revlens.operators import star as ST


def test_heuristic_truth_table(spark):
    rows = [(4.0, None, 0, "neutral"), (4.0, None, 5, "positive"), (4.0, True, 0, "positive"),
            (2.0, None, 0, "negative"), (2.0, True, 5, "neutral"), (3.0, True, 5, "neutral")]
    df = spark.createDataFrame(rows, "rating double, v boolean, h long, want string")
    got = df.select(LB.heuristic_sentiment("rating", "v", "h").alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_heuristic_all_combinations(spark):
    # brute force over ratings 1..5, verified in {T, F, null}, votes 0..9 and null
    import itertools
    rows = list(itertools.product([1.0, 2.0, 3.0, 4.0, 5.0], [True, False, None], list(range(10)) + [None]))
    df = spark.createDataFrame(rows, "rating double, v boolean, h long")
    for r in df.select("*", LB.heuristic_sentiment("rating", "v", "h").alias("g")).collect():
        s = (1 if r.rating >= 4 else -1 if r.rating <= 2 else 0) + (0.5 if r.v else 0) + (0.5 if (r.h or 0) >= 5 else 0)
        want = "positive" if s > 1 else "negative" if s < 0 else "neutral"
        assert r.g == want


def test_majority_vote_table(spark):
    import itertools
    vals = ["positive", "negative", "neutral", None]
    rows = list(itertools.product(vals, vals, vals))
    df = spark.createDataFrame(rows, "a string, b string, c string")
    for r in df.select("*", LB.majority_vote("a", "b", "c").alias("g")).collect():
        v = [r.a, r.b, r.c]
        p, n, u = v.count("positive"), v.count("negative"), v.count("neutral")
        want = "positive" if p > n and p >= u else "negative" if n > p and n > u else "neutral"
        assert r.g == want, v


def test_file_name_filter(spark):
    rows = [("notes.txt", False), ("good é.abc", False), ("ok.abc\n", False), ("ok.abc\r", True),
            ("a.b.txt", True), (None, True)]
    df = spark.createDataFrame(rows, "t string, keep boolean")
    kept = {r.t for r in C.drop_file_names(df, "t").collect()}
    assert kept == {r[0] for r in rows if r[1]}


def test_missing_text_tokens(spark):
    df = spark.createDataFrame([("none",), ("null",), ("n/a",), ("nan",), ("",), (None,)], "t string")
    assert [r.t for r in C.drop_missing_text(df, "t").collect()] == ["none"]


def test_url_filter_keeps_null(spark):
    df = spark.createDataFrame([("http://x",), ("see https://x",), (None,)], "t string")
    assert sorted((r.t or "") for r in C.drop_urls(df, "t").collect()) == ["", "see https://x"]


def test_merge_null_keys_and_fanout(spark):
    r = spark.createDataFrame([(None, "a", 5.0), ("B1", "b", 4.0)], "parent_asin string, text string, rating double")
    m = spark.createDataFrame([(None, "P0"), ("B1", "P1"), ("B1", "P1b")], "parent_asin string, title string")
    keep = ["text", "rating", "product_title"]
    assert L.merge_reviews(r, m, keep=keep).count() == 2          # B1 twice
    assert L.merge_reviews(r, m, keep=keep, null_safe=True).count() == 3


def test_strict_argmax(spark):
    df = spark.createDataFrame([([1.0, 1.0, 0.0],), ([2.0, 1.0, 0.0],), ([0.0, 2.0, 1.0],), ([0.0, 1.0, 2.0],)],
                               "v array<double>")
    assert [r.x for r in df.select(LB.strict_argmax_label("v").alias("x")).collect()] == \
        ["Neutral", "Positive", "Negative", "Neutral"]
    assert [r.x for r in df.select(LB.argmax("v").alias("x")).collect()] == [0, 0, 1, 2]


def test_epoch_ms(spark):
    r = spark.range(1).select(ST.epoch_ms_to_ts(F.lit(1588687990123)).alias("t")).first().t
    assert r.replace(tzinfo=None) == dt.datetime(2020, 5, 5, 14, 13, 10)


def test_label_encoding(spark):
    df = spark.createDataFrame([("positive",), ("negative",), ("neutral",), ("other",)], "s string")
    assert [r.x for r in df.select(LB.encode_label("s").alias("x")).collect()] == [0, 1, 2, None]
    with pytest.raises(Exception):
        df.select(LB.encode_label("s", strict=True)).collect()
    assert [r.x for r in spark.range(3).select(LB.decode_label("id").alias("x")).collect()] == \
        ["Positive", "Negative", "Neutral"]


def test_three_way_split_invariants(spark):
    from revlens.sources import testdata as td
    d = td.labeled_facts(spark, "/root/testdata/sf0.01").select("row_id", "label")
    s = M.three_way_split(d)
    counts = {(r.label, r.split): r["count"] for r in s.groupBy("label", "split").count().collect()}
    n = d.count()
    t = int(0.2 * (n - 3 * 6666) / 3)
    for k in (0, 1, 2):
        assert counts[(k, "train")] == 6666
        assert counts[(k, "test")] == t
    assert s.count() == n and s.select("row_id").distinct().count() == n


def test_oversample_example(spark):
    rows = [(i, "X", 0) for i in range(5)] + [(10 + i, "X", 1) for i in range(2)]
    df = spark.createDataFrame(rows, "row_id long, main_category string, label int")
    out = M.oversample(df)
    c = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert c == {0: 5, 1: 5}
    assert sorted(r.row_id for r in out.filter("label = 0").collect()) == [0, 1, 2, 3, 4]
    assert {r.row_id for r in out.filter("label = 1").collect()} <= {10, 11}


def test_group_and_class_weights(spark):
    df = spark.createDataFrame([(i, "a" if i < 8 else "b") for i in range(10)], "row_id long, main_category string")
    w = {r.main_category: r.sample_weight for r in M.group_weights(df).collect()}
    assert w == {"a": 1.25, "b": 5.0}
    lab = spark.createDataFrame([(0,)] * 6 + [(1,)] * 3 + [(2,)] * 3, "label int")
    cw = {r.label: round(r.class_weight, 4) for r in M.class_weights(lab).collect()}
    assert cw == {0: 0.6667, 1: 1.3333, 2: 1.3333}


def test_ui_subset_shape(spark):
    rows = [(p * 100 + i, "cat", f"prod{p}", 1.0, "a", "x") for p in range(7) for i in range(12)]
    df = spark.createDataFrame(rows, "row_id long, main_category string, product_title string, price double, "
                                     "parent_asin string, cleaned_text string")
    out = ST.ui_subset(df)
    g = {r.product_title: r["count"] for r in out.groupBy("product_title").count().collect()}
    assert g == {f"prod{p}": 10 for p in range(5)}


def test_rank_models_example(spark):
    long = spark.createDataFrame([("m", k, 0.9) for k in ("accuracy", "f1", "precision", "recall")],
                                 "Model_Name string, Metric string, Value double")
    r = MT.rank_models(long).first()
    assert round(r.Score, 6) == 0.857143 and r.auc == 0.0


def test_drift_counter_25_events(spark):
    ev = spark.createDataFrame([(1, i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i)) for i in range(25)],
                               "k long, event_id long, ts timestamp")
    out = DR.drift_counter(ev, "k", "ts", "event_id").orderBy("event_id").collect()
    assert [r.drift_counter for r in out] == [i % 10 for i in range(25)]
    assert [i + 1 for i, r in enumerate(out) if r.triggered] == [11, 21]


def test_drift_decision(spark):
    df = spark.createDataFrame([(0.5,), (0.01,)], "p double")
    assert [r.x for r in df.select(DR.drift_decision(F.col("p")).alias("x")).collect()] == [False, True]
    assert [r.x for r in df.select(DR.drift_decision(F.col("p"), invert=True).alias("x")).collect()] == [True, False]


def _star(spark, sentiments_by_cat):
    cats = spark.createDataFrame([(i + 1, c) for i, c in enumerate(sentiments_by_cat)], "category_id long, category_name string")
    prods = spark.createDataFrame([(i + 1, i + 1, f"p{i}", 1.0, "a") for i in range(len(sentiments_by_cat))],
                                  "product_id long, category_id long, product_title string, price double, parent_asin string")
    rows = []
    for i, (c, labels) in enumerate(sentiments_by_cat.items()):
        rows += [(i + 1, s, 3.0, 1, dt.datetime(2020, 1, 1)) for s in labels]
    revs = spark.createDataFrame(rows, "product_id long, final_sentiment string, rating double, helpful_vote long, timestamp timestamp")
    return revs, prods, cats


def test_empty_category_percentage_is_null(spark):
    revs, prods, cats = _star(spark, {"A": ["positive"], "B": []})
    out = D.positive_percentage(revs, prods, cats, category="B").collect()
    assert out == [] or out[0].positive_percentage is None
    all_ = {r.category_name: r.positive_percentage for r in D.positive_percentage(revs, prods, cats).collect()}
    assert all_["A"] == 100.0


def test_label_case_panels(spark):
    revs, prods, cats = _star(spark, {"A": ["Positive", "positive", "negative"]})
    summ = {r.final_sentiment: r.sentiment_count for r in D.sentiment_summary(revs, prods, cats, "A").collect()}
    assert summ == {"positive": 2, "negative": 1}
    top = D.most_positive_products(revs, prods, cats, "A").collect()
    assert top[0].positive_review_count == 1


def test_metric_safe_name(spark):
    assert spark.range(1).select(TX.metric_safe(F.lit("Arts, Crafts & Sewing")).alias("x")).first().x == \
        "Arts__Crafts___Sewing"


def test_short_class_fails_in_plan(spark):
    df = spark.createDataFrame([(i, i % 3 if i < 250 else 0) for i in range(300)], "row_id long, label int")
    with pytest.raises(Exception):
        M.per_class_sample(df, n=100).collect()   # labels 1 and 2 have 83 rows
    assert M.per_class_sample(df, n=50).count() == 150
