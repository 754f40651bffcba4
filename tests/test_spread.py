"""Work on texts is dealt over tasks, done once, and products stay off the driver."""

import glob

from pyspark.sql import Observation
from pyspark.sql import functions as F

from revlens import session
from revlens.operators import scoring as SC
from revlens.plans import q_pipeline, q_stream
from revlens.sources import testdata as td
from revlens.streaming import live as LV

SF = "/root/testdata/sf0.001"


def test_training_cuts_texts_into_words_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def text(k):
        seen.add(1)
        return "good fine works" if k % 2 else "bad poor broken"

    rows = spark.range(40).select((F.col("id") % 2).cast("double").alias("label"), F.col("id"))
    udf = F.udf(text, "string").asNondeterministic()
    model = SC.train_classifier(rows.withColumn("cleaned_text", udf("id")), num_features=1 << 8, max_iter=3)
    assert seen.value == 40 and len(model.stages) == 4
    again = rows.withColumn("cleaned_text", F.when(F.col("label") == 1, "good fine").otherwise("bad broken"))
    assert model.transform(again).where("prediction <> label").isEmpty()


def test_classifier_scores_in_a_session_that_observed(spark):
    rows = spark.range(40).select((F.col("id") % 2).cast("double").alias("label"))
    rows = rows.withColumn("cleaned_text", F.when(F.col("label") == 1, "good fine").otherwise("bad broken"))
    seen = Observation("rows")
    rows.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 40}
    model = SC.train_classifier(rows, num_features=1 << 8, max_iter=3)
    assert model.transform(rows).where("prediction <> label").isEmpty()


def test_stored_reviews_are_dealt_over_tasks(spark):
    """The table has one row group, so one task reads it."""
    rows = q_pipeline._l6_spread(spark, SF)
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, q_pipeline._l6(spark, SF).collect()))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan


def test_arrivals_have_a_file_for_each_task(spark):
    docs = td.table(spark, SF, "documents")
    stream, arrivals = q_stream._arriving(spark, docs, "doc_id", "spread-test")
    path = session._SCRATCH[-1]
    for deliver in arrivals:
        deliver()
    files = glob.glob(f"{path.removeprefix('file:')}/*.parquet")
    assert len(files) >= q_stream.ARRIVALS * spark.sparkContext.defaultParallelism
    assert spark.read.parquet(path).count() == docs.count()


def test_products_of_a_stream_are_not_broadcast(spark):
    live = LV.label_stream(td.raw_reviews(spark, SF), td.raw_metadata(spark, SF))
    plan = live._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
