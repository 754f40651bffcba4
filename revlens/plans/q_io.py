"""Registered source / sink and model-input queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as MT
from ..operators import scoring as SC
from ..session import materialize, scratch_path
from ..sources import io as IO
from ..sources import schemas as S
from ..sources import testdata as td
from .catalog import register
from .q_metrics import _LL_SQL, _ev
from .q_pipeline import _L6_CTES
from .sqltext import tokens_sql
from .sqlviews import with_views


@register("s3_s4_csv_roundtrip", with_views(
    "SELECT row_id, rating, title, nullif(text, '') AS text, parent_asin, timestamp, verified_purchase, helpful_vote "
    "FROM raw_reviews_v",
    "raw_reviews_v"))
def s34(spark, sf):
    """S4 + S3: raw reviews written as CSV (header, a line a record)
    and scanned back with the declared schema - no type inference.  An empty
    cell is a missing value, as CSV has one sign for both."""
    cols = ["row_id", "rating", "title", "text", "parent_asin", "timestamp", "verified_purchase", "helpful_vote"]
    src = td.raw_reviews(spark, sf).select(*cols)
    path = scratch_path(spark, "s4-csv")
    IO.write_table(src, path, fmt="csv", line_records=True)
    return IO.read_table(spark, path, schema=src.schema, fmt="csv", line_records=True)


@register("s1_s2_declared_schema_scan", with_views(
    "SELECT main_category, title, price, store, parent_asin FROM raw_metadata_v", "raw_metadata_v"))
def s12(spark, sf):
    """Product metadata written as JSON lines and scanned with the
    declared METADATA schema (nested columns typed, absent ones null)."""
    src = td.raw_metadata(spark, sf)
    path = scratch_path(spark, "s2-json")
    IO.write_table(src, path, fmt="json")
    back = IO.read_table(spark, path, schema=S.METADATA, fmt="json")
    return back.select("main_category", "title", "price", "store", "parent_asin")


_REVIEW_COLS = "rating, title, text, asin, parent_asin, user_id, timestamp, verified_purchase, helpful_vote"


@register("s1_reviews_scan", with_views(f"SELECT {_REVIEW_COLS}, NULL AS n_images FROM raw_reviews_v",
                                        "raw_reviews_v"))
def s1(spark, sf):
    """Raw reviews written as JSON lines and scanned with the declared
    REVIEWS schema (nested columns typed, absent ones null)."""
    path = scratch_path(spark, "s1-json")
    IO.write_table(td.raw_reviews(spark, sf), path, fmt="json")
    back = IO.read_table(spark, path, schema=S.REVIEWS, fmt="json")
    return back.selectExpr(*_REVIEW_COLS.split(", "), "size(images) AS n_images")


@register("s7_latin1_scan", """SELECT doc_id AS row_id, text,
  CAST(floor(doc_id / 100000) AS BIGINT) AS chunk FROM documents""")
def s7(spark, sf):
    """Texts stored as Latin-1 CSV and scanned with that encoding, with
    the chunk that a reader of 100 000 rows at a time would see."""
    src = td.table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), "text")
    path = scratch_path(spark, "s7-csv")
    IO.write_table(src, path, fmt="csv", encoding="ISO-8859-1", line_records=True)
    back = IO.read_table(spark, path, schema=src.schema, fmt="csv", encoding="ISO-8859-1", line_records=True)
    return back.withColumn("chunk", F.floor(F.col("row_id") / 100_000).cast("long"))


@register("s8_bounded_scan", """SELECT doc_id, source FROM (SELECT *, row_number() OVER () AS place FROM documents) d
WHERE place <= 7""")
def s8(spark, sf):
    """The first 7 rows of a table in its own order (nrows=7), by the
    rows' places in the files."""
    return IO.first_rows(spark, f"{sf.rstrip('/')}/documents.parquet", 7).select("doc_id", "source")


@register("s11_metrics_sink", _ev(f"SELECT Model_Name, 'log_loss' AS Metric, log_loss AS Value FROM ({_LL_SQL}) t "
                                  f"UNION ALL SELECT Model_Name, 'log_loss', log_loss FROM ({_LL_SQL}) t2"))
def s11(spark, sf):
    """Two evaluation runs appended to one metrics table, the second
    one tried twice; read back."""
    from .q_metrics import _preds
    long = MT.to_long(MT.log_loss(_preds(spark, sf)), metrics=["log_loss"])
    path = scratch_path(spark, "s11-metrics")
    for run in ("first", "second", "second"):
        IO.append_metrics(long, path, run)
    return IO.read_metrics(spark, path).select("Model_Name", "Metric", "Value")


_VOCAB_SQL = f"""SELECT token, CAST(row_number() OVER (ORDER BY cnt DESC, token) + 1 AS INTEGER) AS id FROM (
  SELECT tok AS token, COUNT(*) AS cnt FROM (SELECT unnest({tokens_sql('text')}) AS tok FROM documents) a
  GROUP BY tok ORDER BY cnt DESC, tok LIMIT 30000) b"""
_TOK_SQL = f"""SELECT d.doc_id AS row_id,
  list_concat(coalesce(t.ids, []::INTEGER[]), list_transform(range(GREATEST(256 - coalesce(len(t.ids), 0), 0)), lambda x: 0)) AS input_ids,
  list_concat(list_transform(range(coalesce(len(t.ids), 0)), lambda x: 1),
              list_transform(range(GREATEST(256 - coalesce(len(t.ids), 0), 0)), lambda x: 0)) AS attention_mask
FROM documents d LEFT JOIN (
  SELECT row_id, list(id ORDER BY pos) AS ids FROM (
    SELECT p.row_id, p.pos, coalesce(v.id, 1) AS id FROM (
      SELECT doc_id AS row_id, generate_subscripts(tk, 1) - 1 AS pos, unnest(tk) AS token
      FROM (SELECT doc_id, {tokens_sql('text')} AS tk FROM documents) q) p
    LEFT JOIN vocab v ON p.token = v.token WHERE p.pos < 256) z GROUP BY row_id) t ON d.doc_id = t.row_id"""


@register("e2_tokenize_fixed", with_views(_TOK_SQL, extra={"vocab": _VOCAB_SQL}))
def e2(spark, sf):
    """E2 (+S12): word ids padded / truncated to 256 with an attention mask;
    the model knows the 30 000 most frequent document words."""
    docs = td.table(spark, sf, "documents").withColumnRenamed("doc_id", "row_id")
    vocab = SC.build_vocab(docs, "text", 30000)
    return SC.tokenize_fixed(docs, vocab, "text", "row_id", max_length=256)


@register("s13_scoring_request", with_views("""SELECT CAST(floor(row_id / 256) AS BIGINT) AS batch,
  to_json({'instances': list({'input_ids': input_ids, 'attention_mask': attention_mask} ORDER BY row_id)}) AS request,
  COUNT(*) AS n_instances
FROM tok GROUP BY CAST(floor(row_id / 256) AS BIGINT)""", extra={"vocab": _VOCAB_SQL, "tok": _TOK_SQL}))
def s13(spark, sf):
    """S12 + S13: tokenized rows stored as Parquet arrays, read back and
    exported as {"instances": [...]} request documents (one per batch of
    ids), so no request holds the whole table."""
    docs = td.table(spark, sf, "documents").withColumnRenamed("doc_id", "row_id")
    tok = SC.tokenize_fixed(docs, SC.build_vocab(docs, "text", 30000), "text", "row_id", max_length=256)
    path = scratch_path(spark, "s12-tokens")
    IO.write_table(tok, path)
    back = spark.read.parquet(path)
    return IO.scoring_request(back.withColumn("batch", F.floor(F.col("row_id") / 256)), batch_col="batch")


@register("e3_train_classifier", with_views("SELECT count(*) AS n, true AS accurate FROM labeled",
                                            "raw_reviews_v", "raw_metadata_v", extra=_L6_CTES))
def e3(spark, sf):
    """E3 (re-aimed): distributed text classifier trained on the labeled
    reviews with category sample weights (M9): the rows it scored and
    whether it beats the commonest class by a tenth on them."""
    from ..operators import sampling as M
    from .q_pipeline import _l6_spread
    from ..functions.labels import encode_label
    lab = materialize(_l6_spread(spark, sf).withColumn("label", encode_label("final_sentiment").cast("double")), "labeled")
    lab = M.add_group_weights(lab, "main_category")
    model = SC.train_classifier(lab, "cleaned_text", "label", weight_col="sample_weight",
                                num_features=1 << 16, max_iter=20)
    hits = model.transform(lab).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction") == F.col("label")).alias("right"))
    return hits.agg(F.sum("n").alias("n"),
                    (F.sum("right") >= F.max("n") + F.sum("n") / 10).alias("accurate"))
