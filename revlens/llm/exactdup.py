"""Exact duplicates by skew-safe combining, in DataFrame functions alone.

Whole texts are grouping keys at every stage, so content is compared in
full; the SHA-256 digest beside them only deals rows.

1. local: each task combines its own copies of a text (map-side combine);
2. salted digest groups: rows are merged by digest, salt and text.  A digest
   that holds a noticeable share of all rows has many salts, taken from the
   document id; every other digest has one, so its group is whole here;
3. global: the winners of the salted digests, one per salt and text, are
   combined by text into the row that stays and the size of the group.

Texts cross the network once.  Digests with many rows are found by counting
narrow (id, digest) rows first, and the result per document comes from a
narrow join on digest and salt, so a hot digest is spread there too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import fresh

#: Salts of a hot digest: a task combines at most so many rows of its text.
SALTS = 64
#: A digest is hot from this share of all rows on (one in so many), so there
#: are never more hot digests than this: their list may be broadcast.
HOT_ONE_IN = 10_000


def content_digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def _salted(rows: DataFrame, hot: DataFrame, salts: int) -> DataFrame:
    """``rows`` (id, digest, ...) with ``salt``: 0, or from 1 on if hot."""
    marked = rows.join(F.broadcast(hot.select("digest", F.lit(True).alias("hot"))), "digest", "left")
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(salts)) + 1).otherwise(0)
    return marked.withColumn("salt", salt.cast("int")).drop("hot")


def _combined(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
               hot_one_in: int = HOT_ONE_IN, digest=content_digest) -> DataFrame:
    """One row per row of ``docs``: ``id, keep_id, group_size, kept, digest``.

    Texts are equal when they are identical; null is the empty text.  Of
    equal texts the row with the largest id stays (null below all others;
    of null ids alone, the null).  Rows that repeat both id and text are one
    document given several times: each has its row, all count in
    ``group_size``, and all are ``kept`` if their id stays (`dedup` leaves
    one).  Other columns play no part; an empty table gives no rows.

    Should a digest ever stand for several texts, the documents under it are
    grouped again and joined by the text itself."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("digest", digest(F.col("text")))
    narrow = materialize(rows.select("id", "digest"), "digests")
    sizes = materialize(narrow.groupBy("digest").agg(F.count(F.lit(1)).alias("n")), "digest-sizes")
    total = sizes.select(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = sizes.where(F.col("n") * hot_one_in >= total)

    first = _salted(rows, hot, salts).withColumnRenamed("id", "keep_id").withColumn("group_size", F.lit(1))
    merged = _combined(first, "digest", "salt", "text")
    merged = materialize(merged.withColumn("text", F.when(F.col("salt") > 0, F.col("text"))), "salt-winners")
    cold = merged.where("salt = 0").drop("text")
    salted = merged.where("salt > 0")
    whole = materialize(_combined(salted, "digest", "text"), "hot-winners")
    won = cold.unionByName(salted.select("digest", "salt", "text").join(whole, ["digest", "text"]).drop("text"))

    def members(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        return left.join(right, keys).select("id", "keep_id", "group_size",
                                             F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")

    if cold.count() + whole.count() == sizes.count():  # every digest is one text
        return members(_salted(narrow, hot, salts), won, ["digest", "salt"])
    texts = cold.select("digest").unionAll(whole.select("digest")).groupBy("digest").count().where("count > 1")
    texts = materialize(texts.select("digest"), "shared-digests")
    alone = members(_salted(narrow.join(texts, "digest", "left_anti"), hot, salts), won, ["digest", "salt"])
    told = rows.join(texts, "digest")
    groups = _combined(told.select("digest", "text", F.col("id").alias("keep_id"), F.lit(1).alias("group_size")),
                       "digest", "text")
    return alone.unionByName(members(told, groups, ["digest", "text"]))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one per text.
    Of rows that repeat id and text, the one with the smallest other columns
    (by hash) stays."""
    found = duplicates(docs, id_col, text_col)
    keep = found.where("kept").select(F.col("id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    mark, place = fresh(docs, "digest"), fresh(docs, "place")
    rows = docs.withColumn(mark, content_digest(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    first = Window.partitionBy(id_col, mark).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    same = [rows[id_col].eqNullSafe(keep["_id"]), rows[mark] == keep["_digest"]]
    return (rows.join(keep, same, "left_semi").withColumn(place, F.row_number().over(first))
                .where(F.col(place) == 1).drop(mark, place))
