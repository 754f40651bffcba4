"""The reference's own unit tests, re-expressed on Spark DataFrames."""

from pyspark.sql import functions as F

from revlens.functions import compute_once
from revlens.functions import labels as LB
from revlens.functions import lexicon as LX
from revlens.functions.text import word_tokens
from revlens.operators import clean as C
from revlens.operators import labeling as L


def test_merge_data(spark):
    reviews = spark.createDataFrame(
        [("B001", "Review A", "Great product!", 5.0, True, 10),
         ("B002", "Review B", "Not bad", 3.0, False, 2),
         ("B003", "Review C", "Could be better", 1.0, True, 1)],
        "parent_asin string, title string, text string, rating double, verified_purchase boolean, helpful_vote long")
    meta = spark.createDataFrame(
        [("B001", "Product A", "Store A", 29.99), ("B002", "Product B", "Store B", 19.99),
         ("B003", "Product C", "Store C", 9.99)],
        "parent_asin string, title string, store string, price double")
    m = L.merge_reviews(reviews, meta, keep=L.NARROW)
    assert "product_title" in m.columns
    assert m.count() == 3


def test_remove_html_tags(spark):
    df = spark.createDataFrame([("<p>Great product!</p>",), ("<div>Not good</div>",)], "text string")
    out = [r.cleaned_text for r in C.strip_html_tags(df).collect()]
    assert out == ["great product!", "not good"]


def test_filter_urls_paths(spark):
    df = spark.createDataFrame(
        [("Sample text", "Review with content"), ("Sample text", "https://www.example.com"),
         ("Sample text", "Some other simple review")], "text string, cleaned_text string")
    out = C.drop_file_names(C.drop_urls(df)).drop("text")
    vals = {r.cleaned_text for r in out.collect()}
    assert len(vals) == 2
    assert vals == {"Review with content", "Some other simple review"}


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_heuristic_sentiment(spark):
    df = spark.createDataFrame([(5.0, True, 6)], "rating double, verified_purchase boolean, helpful_vote long")
    r = df.select(LB.heuristic_sentiment("rating", "verified_purchase", "helpful_vote").alias("x")).first().x
    assert r == "positive"


def _scored(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    df = compute_once(df, _tokens=word_tokens("text"))
    return df.select(LX.sentiment_a(LX.grade_sum("_tokens")).alias("a"),
                     LX.sentiment_b(LX.polarity_sum("_tokens")).alias("b"),
                     LX.mean_polarity(LX.polarity_sum("_tokens")).alias("m")).first()


def test_lexicon_a_sentiment(spark):
    assert _scored(spark, "I love this!").a == "positive"
    assert _scored(spark, None).a is None and _scored(spark, "").a == "neutral"


def test_lexicon_b_sentiment(spark):
    assert _scored(spark, "I hate this!").b == "negative"
    # the scorers read differently: negations and boosters count for B alone
    for text, a, b, m in [("it is not good", "positive", "negative", -3 / 8), ("not very happy", "positive", "negative", -0.5),
                          ("very good", "positive", "positive", 1.0), ("hardly broken", "negative", "positive", 3 / 8),
                          ("cheap but fine", "neutral", "neutral", 0.0)]:
        got = _scored(spark, text)
        assert (got.a, got.b, got.m) == (a, b, m), text


def test_majority_vote(spark):
    assert _one(spark, LB.majority_vote(F.lit("positive"), F.lit("positive"), F.lit("neutral"))) == "positive"
