"""Queries of the training-data operators, one per operator, each over its
whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare

#: name -> (function, oracle SQL or None)
QUERIES: dict[str, tuple] = {}


def query(fn, sql: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = (run, sql)
    return fn


def query_like(sql: str):
    """`query` with the same rows as DuckDB SQL."""
    return lambda fn: query(fn, sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_simhash(spark, sf_dir):
    """SimHash components of `documents`: 3-word shingles, 2 bits."""
    from .simhash import simhash_components
    out = simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=2, seed=42)
    return out.select(F.col("id").alias("doc_id"),
                      F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("component").alias("component_id"))


@query
def op3_winnowing(spark, sf_dir):
    """Winnowed fingerprints of `documents` and of their edited texts."""
    from .winnow import edited_fingerprints
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op5_packing(spark, sf_dir):
    """Power-of-two packing of all `documents` into sequences of 2048."""
    from .packing import pack
    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=1, length=2048)


@query
def op8_sentencepiece(spark, sf_dir):
    """Merge-type encoding and decoding of all `documents`."""
    from .spbpe import encode_decode
    return encode_decode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op9_warc(spark, sf_dir):
    """WARC records of all `pages`, written into ZIP archives and read back."""
    from .warczip import round_trip
    out = round_trip(spark, table(spark, sf_dir, "pages"), min_revisit_bytes=0)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op10_toxicity(spark, sf_dir):
    """Toxicity scores of all `documents`, learned outside the held-out fold."""
    from .toxicity import score_documents
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_pii(spark, sf_dir):
    """Personal data in all `documents`: base spans and those the labelers add."""
    from .pii import find
    return find(table(spark, sf_dir, "documents"))


@query
def op2_html(spark, sf_dir):
    """Main text of all `pages` through wrappers inferred per host."""
    from .wrapper import extract_pages
    return extract_pages(table(spark, sf_dir, "pages"))


@query
def op6_embeddings(spark, sf_dir):
    """Near-duplicate components of all `embeddings` at cosine 0.95."""
    from .embeddup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


@query
def op4_substrings(spark, sf_dir):
    """Passages of 50 words or more that `documents` share: the later
    document, its words, and an earlier document with the passage."""
    from .passages import repeated_passages
    out = repeated_passages(table(spark, sf_dir, "documents"), min_words=50, shingle=5, similarity=0.8)
    return out.select(F.col("id").alias("doc_id"), "start_word", "end_word", F.col("other_id").alias("other_doc_id"),
                      "other_start", "other_end", "similarity")


OP11_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query_like(OP11_SQL)
def op11_exact_dedup(spark, sf_dir):
    """Exact duplicates of all `documents`; the largest doc_id stays."""
    from .exactdup import duplicates
    out = duplicates(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
one AS (SELECT lang, w[i] AS phrase, count(*) AS f FROM places GROUP BY ALL),
two AS (SELECT lang, w[i] AS a, w[i + 1] AS b, count(*) AS f FROM places WHERE i < len(w) GROUP BY ALL),
three AS (SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, count(*) AS f FROM places
          WHERE i + 1 < len(w) GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, sum(f) AS n FROM one GROUP BY lang),
cuts AS (
  SELECT two.lang, two.a || ' ' || two.b AS phrase, two.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM two JOIN one x ON x.lang = two.lang AND x.phrase = two.a JOIN one y ON y.lang = two.lang AND y.phrase = two.b
  WHERE two.f >= 10
    AND NOT EXISTS (SELECT 1 FROM three t WHERE t.lang = two.lang AND t.a = two.a AND t.b = two.b AND 100 * t.f >= 50 * two.f)
    AND NOT EXISTS (SELECT 1 FROM three t WHERE t.lang = two.lang AND t.b = two.a AND t.c = two.b AND 100 * t.f >= 50 * two.f)
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, t.f, 1, x.f, y.f
  FROM three t JOIN one x ON x.lang = t.lang AND x.phrase = t.a
       JOIN two y ON y.lang = t.lang AND y.a = t.b AND y.b = t.c
  UNION ALL
  SELECT t.lang, t.a || ' ' || t.b || ' ' || t.c, t.f, 2, x.f, y.f
  FROM three t JOIN two x ON x.lang = t.lang AND x.a = t.a AND x.b = t.b
       JOIN one y ON y.lang = t.lang AND y.phrase = t.c),
scored AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query_like(OP12_SQL)
def op12_collocations(spark, sf_dir):
    """First 2000 phrases of two and three words per language of `documents`."""
    from .collocations import collocations
    return collocations(table(spark, sf_dir, "documents"), top=2000, min_count=10, cover=50)


@query
def op13_alignment(spark, sf_dir):
    """Alignment of byte-level and piece tokens over all `documents`."""
    from .alignment import align_documents
    return align_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"),
                           vocabulary("piece_bpe_32k.model"))
