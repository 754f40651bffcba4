"""The batch scorer's model against a plain naive Bayes, and held out."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from revlens.operators import scoring as SC
from revlens.sources import testdata as td


def plain(rows, texts):
    cut = [(re.findall(r"\b\w\w+\b", t.lower()), y) for t, y in rows if t is not None]
    bucket = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:4], 16)
    counts = [{}, {}, {}]
    for words, y in cut:
        for w in words:
            counts[y][bucket(w)] = counts[y].get(bucket(w), 0) + 1
    out = []
    for t in texts:
        s = [math.log((sum(y == k for _, y in cut) + 1) / (len(cut) + 3)) for k in range(3)]
        for w in re.findall(r"\b\w\w+\b", (t or "").lower()):
            for k in range(3):
                s[k] += math.log((counts[k].get(bucket(w), 0) + 0.01) / (sum(counts[k].values()) + 655.36))
        e = [math.exp(x - max(s)) for x in s]
        out.append([x / sum(e) for x in e])
    return out


def test_matches_plain_naive_bayes(spark):
    train = [("good great nice", 0), ("bad awful", 1), ("it is a table", 2), ("great good été", 0), (None, 1), ("", 2)]
    texts = ["good table", "awful bad great", "unknown words only", "", None, "good " * 3000]
    weights = SC.fit_text_model(spark.createDataFrame(train, "text string, label int"), "text", "label")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    got = {r.doc_id: r for r in SC.score_texts(df, weights, "m").collect()}
    for i, want in enumerate(plain(train, texts)):
        assert got[i].probs == pytest.approx(want, abs=1e-3 if i == 5 else 1e-5)
        assert got[i].prediction == max(range(3), key=lambda k: (want[k], -k))


def test_empty_training_and_input(spark):
    none = spark.createDataFrame([], "doc_id int, text string, label int")
    weights = SC.fit_text_model(none, "text", "label")
    assert SC.score_texts(none, weights, "m").count() == 0
    one = spark.createDataFrame([(1, "some words")], "doc_id int, text string")
    assert SC.score_texts(one, weights, "m").first().probs == pytest.approx([1 / 3] * 3, abs=1e-6)


def test_learns_from_words_alone(spark):
    """Held-out toxic documents are told apart without their label."""
    sf = "/root/testdata/sf0.01"
    rows = td.table(spark, sf, "documents").select("doc_id", "text").join(
        td.eval_labels(spark, sf).select("doc_id", "label"), "doc_id")
    weights = SC.fit_text_model(rows.where("doc_id % 5 <> 0"), "text", "label")
    test = rows.where("doc_id % 5 = 0")
    out = SC.score_texts(test.drop("label"), weights, "m").join(test, "doc_id")
    hit, n, common = out.select(F.count_if(F.col("prediction") == F.col("label")), F.count(F.lit(1)),
                                F.greatest(*[F.count_if(F.col("label") == k) for k in range(3)])).first()
    assert n > 50 and hit > common, (hit, n, common)
