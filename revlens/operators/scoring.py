"""Model scoring, tokenization and training.

E1 runs a scorer object over Arrow batches: it is loaded once per Python
worker, and any object with ``predict_scores(pandas.DataFrame) ->
numpy.ndarray[n, classes]`` can be plugged in.  The scorer here is a naive
Bayes text model over hashed words, fitted by Spark aggregates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

N_CLASSES = 3
#: Word buckets of the text model (a bounded table of weights), and the
#: whole-number unit of its log weights.
BUCKETS = 1 << 16
UNIT = 1_000_000


def word_bucket(token: Column) -> Column:
    """Bucket of a word: the first 16 bits of its md5."""
    return F.conv(F.substring(F.md5(token), 1, 4), 16, 10).cast("int")


def fit_text_model(df: DataFrame, text_col: str, label_col: str, smoothing: float = 0.01) -> DataFrame:
    """E3 for the batch scorer: multinomial naive Bayes; every bucket counts
    as met ``smoothing`` times in each class.  Returns ``bucket, w0, w1, w2``: log weights of words in
    classes 0..2 in units of 1 / UNIT; bucket -1 is a word never seen, -2 the
    class itself.  Words are counted with partial aggregates, so at most
    BUCKETS rows per class and task are shuffled; rows without text or with
    another label are left out."""
    from ..functions.text import word_tokens
    rows = df.where(F.col(text_col).isNotNull() & F.col(label_col).isin(*range(N_CLASSES)))
    words = rows.select(F.col(label_col).alias("c"), F.explode(word_tokens(text_col)).alias("word"))
    per_class = [F.count_if(F.col("c") == k).alias(f"n{k}") for k in range(N_CLASSES)]
    counts = words.groupBy(word_bucket(F.col("word")).alias("bucket")).agg(*per_class)
    total = counts.agg(*[F.coalesce(F.sum(f"n{k}"), F.lit(0)).alias(f"t{k}") for k in range(N_CLASSES)])
    unseen = df.sparkSession.range(1).select(F.lit(-1).alias("bucket"), *[F.lit(0).cast("bigint").alias(f"n{k}")
                                                                        for k in range(N_CLASSES)])
    weights = counts.unionByName(unseen).join(total).select(  # one row of totals
        "bucket", *[_log_share(F.col(f"n{k}") + F.lit(smoothing), F.col(f"t{k}") + F.lit(smoothing * BUCKETS)).alias(f"w{k}") for k in range(N_CLASSES)])
    classes = rows.select(F.col(label_col).alias("c")).agg(*per_class)
    every = sum((F.col(f"n{k}") for k in range(N_CLASSES)), F.lit(0))
    prior = classes.select(F.lit(-2).alias("bucket"), *[_log_share(F.col(f"n{k}") + 1, every + N_CLASSES).alias(f"w{k}")
                                                       for k in range(N_CLASSES)])
    return weights.unionByName(prior)


def _log_share(part: Column, whole: Column) -> Column:
    return F.round(F.log(part / whole) * UNIT).cast("bigint")


class TextScorer:
    """Scores ``buckets`` (lists of word buckets) by the weights of
    `fit_text_model`: the classes' likelihoods, the largest being 1.  Sums
    are whole numbers, so the order of the words does not matter."""

    def __init__(self, weights: pd.DataFrame):
        w = weights.set_index("bucket")[[f"w{k}" for k in range(N_CLASSES)]]
        self.table = np.tile(w.loc[-1].to_numpy(np.int64), (BUCKETS, 1))
        seen = w[w.index >= 0]
        self.table[seen.index.to_numpy()] = seen.to_numpy(np.int64)
        self.prior = w.loc[-2].to_numpy(np.int64)

    def predict_scores(self, pdf: pd.DataFrame) -> np.ndarray:
        sums = [self.prior + self.table[np.asarray(b, np.int64)].sum(axis=0) for b in pdf["buckets"]]
        total = np.array(sums, np.int64).reshape(-1, N_CLASSES)
        return np.exp((total - total.max(axis=1, keepdims=True)) / UNIT)


def score_texts(df: DataFrame, weights: DataFrame, model_name: str, text_col: str = "text",
                id_cols=("doc_id",)) -> DataFrame:
    """Class probabilities of texts under `fit_text_model` weights (at
    most BUCKETS + 2 rows, which go to every worker).  Words are cut and
    hashed by Spark; a text without words gets the classes' own shares."""
    from ..functions.text import word_tokens
    model = df.sparkSession.sparkContext.broadcast(weights.toPandas())
    buckets = F.coalesce(F.transform(word_tokens(text_col), word_bucket), F.array().cast("array<int>"))
    rows = df.select(*id_cols, buckets.alias("buckets"))
    return score_batches(rows, lambda: TextScorer(model.value), model_name, id_cols)


def score_batches(df: DataFrame, scorer_factory, model_name: str,
                  id_cols=("doc_id",)) -> DataFrame:
    """E1 (Python form): run a pluggable scorer on Arrow batches.

    ``scorer_factory()`` is called once per task, so a heavy model is loaded
    once per batch stream, not per row.  Output: id columns, Model_Name,
    probs (array<double>), prediction (first index of the max)."""
    in_cols = list(df.columns)
    ids = list(id_cols)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = scorer_factory()
        for pdf in batches:
            sc = scorer.predict_scores(pdf)
            probs = sc / sc.sum(axis=1, keepdims=True)
            out = pdf[ids].copy()
            out["Model_Name"] = model_name
            out["probs"] = list(probs)
            out["prediction"] = probs.argmax(axis=1).astype(np.int32)
            yield out

    fields = ", ".join(f"{c} {dict(df.dtypes)[c]}" for c in ids)
    schema = f"{fields}, Model_Name string, probs array<double>, prediction int"
    return df.select(*in_cols).mapInPandas(run, schema)


def tokenize_fixed(df: DataFrame, vocab: DataFrame, text_col: str = "cleaned_text",
                   id_col: str = "row_id", max_length: int = 256, unk_id: int = 1,
                   pad_id: int = 0) -> DataFrame:
    """Word-level ids padded / truncated to ``max_length`` plus an
    attention mask.  Tokens are looked up in ``vocab`` (token, id) by a join
    on the exploded (row, position, token) table and re-assembled in
    position order per row; a row's array never exceeds its own token count.
    ``vocab`` joins by size: the planner broadcasts a small one, and a large
    one is shuffled with frequent tokens split by adaptive execution.
    """
    from ..functions.text import word_tokens
    toks = df.select(id_col, F.posexplode(F.slice(word_tokens(text_col), 1, max_length)).alias("pos", "token"))
    ids = toks.join(vocab, "token", "left").withColumn("id", F.coalesce(F.col("id"), F.lit(unk_id)))
    per_row = ids.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("_p"))
    base = df.select(id_col).join(per_row, id_col, "left")
    arr = F.coalesce(F.transform("_p", lambda s: s["id"]), F.array().cast("array<int>"))
    n = F.size(arr)
    pad = F.array_repeat(F.lit(pad_id), F.greatest(F.lit(max_length) - n, F.lit(0)))
    return base.select(
        id_col,
        F.concat(arr.cast("array<int>"), pad).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), n), pad).alias("attention_mask"))


def build_vocab(df: DataFrame, text_col: str = "cleaned_text", size: int = 30000,
                first_id: int = 2) -> DataFrame:
    """Vocabulary of a model with an embedding table of ``size`` words: the
    most frequent tokens of all texts (ids from ``first_id``; 0 = padding,
    1 = unknown).  ``size`` is a parameter of the model, as its sequence
    length is.  Counting is a partial aggregate; the top ``size`` is a
    bounded top-k."""
    from ..functions.text import word_tokens
    counts = df.select(F.explode(word_tokens(text_col)).alias("token")).groupBy("token").count()
    top = counts.orderBy(F.desc("count"), "token").limit(size)
    w = Window.orderBy(F.desc("count"), "token")  # over at most `size` rows
    return top.select("token", (F.row_number().over(w) + first_id - 1).cast("int").alias("id"))


def train_classifier(df: DataFrame, text_col: str = "cleaned_text", label_col: str = "label",
                     weight_col: str | None = None, num_features: int = 1 << 18, max_iter: int = 50):
    """E3 (re-aimed): a distributed text classifier - tokenizer, hashed term
    frequencies, IDF, multinomial logistic regression - with optional
    per-row weights from M9 / M10.  Returns the fitted PipelineModel.

    The texts are cut into words once: the term frequencies are written, and
    the passes of the later stages read them."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=r"(?U)\W+", minTokenLength=2)
    tf = HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="features")
    lr = LogisticRegression(labelCol=label_col, featuresCol="features", maxIter=max_iter,
                            family="multinomial", **({"weightCol": weight_col} if weight_col else {}))
    columns = [label_col, *([weight_col] if weight_col else []), "_tf"]
    counted = materialize(tf.transform(tok.transform(df)).select(*columns), "term-counts")
    idf_model = idf.fit(counted)
    model = lr.fit(idf_model.transform(counted))
    # the training summary holds the session, which cannot go to tasks once it has observed a query
    model._java_obj.setSummary(df.sparkSession._jvm.scala.Option.empty())
    return PipelineModel(stages=[tok, tf, idf_model, model])
