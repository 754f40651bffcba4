"""The test-data adapter as SQL common table expressions (DuckDB dialect),
used by the oracle queries.  Mirrors `revlens.sources.testdata`."""

from __future__ import annotations

from ..sources.testdata import (DOC_TO_PRODUCT_STRIDE, TEXT_REVIEW_EPOCH_MS,
                                TEXT_REVIEW_STEP_MS)


def heuristic_sql(rating: str, verified: str, helpful: str) -> str:
    points = (f"(coalesce({rating} >= 4, false)::INT - coalesce({rating} <= 2, false)::INT + 0.5 * coalesce({verified}, false)::INT"
              f" + 0.5 * (coalesce({helpful}, 0) >= 5)::INT)")
    return f"(CASE WHEN {points} > 1 THEN 'positive' WHEN {points} < 0 THEN 'negative' ELSE 'neutral' END)"


# Review text of a document, written apart from the engine's adapter.
REVIEW_TEXT_SQL = """CASE WHEN text IS NULL THEN NULL
  WHEN doc_id % 13 = 0 THEN (['https://shop.example.com/item', 'photo_01.jpg', 'N/A', '', 'null', 'http://a.example',
    'caf&eacute; &amp; bar &#8217;s <b title=''a>b''>great</b>', '  '])[1 + (doc_id // 13) % 8]
  ELSE (['', 'very good', 'not good', 'the best', 'really bad', 'never great', 'cheap but fine', 'not very happy',
    'awful', 'works well', 'hardly broken'])[1 + doc_id % 11] || ' ' || text END"""

VIEWS = {
    "categories_v": """
  SELECT CAST(row_number() OVER (ORDER BY min(p_partkey), p_type) AS BIGINT) AS category_id,
         p_type AS category_name
  FROM part GROUP BY p_type""",
    "products_v": """
  SELECT p.p_partkey AS product_id, c.category_id, p.p_name AS product_title,
         p.p_retailprice AS price, CAST(p.p_partkey AS VARCHAR) AS parent_asin, p.p_brand AS store
  FROM part p JOIN categories_v c ON p.p_type = c.category_name""",
    "reviews_base_v": """
  SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey AS product_id,
         CAST(1 + ((l_linenumber - 1) % 5) AS DOUBLE) AS rating,
         CAST(floor(l_quantity) AS BIGINT) % 10 AS helpful_vote,
         (l_returnflag = 'R') AS verified_purchase,
         l_shipdate AS timestamp, row_number() OVER () - 1 AS row_id
  FROM lineitem""",
    "reviews_v": f"""
  SELECT *, {heuristic_sql('rating', 'verified_purchase', 'helpful_vote')} AS final_sentiment
  FROM reviews_base_v""",
    "raw_reviews_v": f"""
  SELECT doc_id AS row_id, CAST(1 + doc_id % 5 AS DOUBLE) AS rating, source AS title, {REVIEW_TEXT_SQL} AS text,
         CAST((doc_id * {DOC_TO_PRODUCT_STRIDE}) % (SELECT count(*) FROM part) AS VARCHAR) AS asin,
         CAST((doc_id * {DOC_TO_PRODUCT_STRIDE}) % (SELECT count(*) FROM part) AS VARCHAR) AS parent_asin,
         lang AS user_id,
         CAST({TEXT_REVIEW_EPOCH_MS} + doc_id * {TEXT_REVIEW_STEP_MS} AS BIGINT) AS timestamp,
         (doc_id % 3 <> 0) AS verified_purchase,
         n_chars % 10 AS helpful_vote
  FROM documents""",
    "raw_metadata_v": """
  SELECT p_type AS main_category, p_name AS title, CAST(p_size AS DOUBLE) / 10.0 AS average_rating,
         CAST(p_size AS BIGINT) AS rating_number, p_retailprice AS price, p_brand AS store,
         CAST(p_partkey AS VARCHAR) AS parent_asin
  FROM part""",
    "labeled_v": """
  SELECT r.row_id, r.product_id, r.rating, r.helpful_vote, r.timestamp, r.final_sentiment,
         CAST(CASE r.final_sentiment WHEN 'positive' THEN 0 WHEN 'negative' THEN 1 WHEN 'neutral' THEN 2 END
              AS INTEGER) AS label,
         c.category_name AS main_category, p.store
  FROM reviews_v r JOIN products_v p ON r.product_id = p.product_id
  JOIN categories_v c ON p.category_id = c.category_id""",
    "eval_labels_v": """
  SELECT l.doc_id, d.source AS main_category, d.lang AS store, d.n_chars,
         CAST(CASE WHEN l.toxic = 1 THEN 1 WHEN l.quality = 1 THEN 0 ELSE 2 END AS INTEGER) AS label
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
}

# View dependencies, so `with_views` can include what a query needs.
DEPS = {
    "products_v": ["categories_v"],
    "reviews_v": ["reviews_base_v"],
    "labeled_v": ["reviews_v", "products_v"],
}


# The same views with a review's rank among the reviews of known products as
# its row id, where the others have its place in the files.
RANKED_VIEWS = {
    **VIEWS,
    "reviews_base_v": VIEWS["reviews_base_v"].replace(", row_number() OVER () - 1 AS row_id", ""),
    "labeled_v": """
  SELECT CAST(row_number() OVER (ORDER BY r.l_orderkey, r.l_linenumber, r.product_id, r.l_suppkey) - 1 AS BIGINT)
           AS row_id,
         r.product_id, r.rating, r.helpful_vote, r.timestamp, r.final_sentiment,
         CAST(CASE r.final_sentiment WHEN 'positive' THEN 0 WHEN 'negative' THEN 1 WHEN 'neutral' THEN 2 END
              AS INTEGER) AS label,
         c.category_name AS main_category, p.store
  FROM reviews_v r JOIN products_v p ON r.product_id = p.product_id
  JOIN categories_v c ON p.category_id = c.category_id""",
}


def with_views(body: str, *names: str, extra: dict[str, str] | None = None, views: dict[str, str] = VIEWS) -> str:
    """Prefix ``body`` with a WITH clause defining ``names`` (and their
    dependencies) out of ``views`` plus any ``extra`` CTEs (appended in order)."""
    ordered: list[str] = []

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({views[n]}\n)" for n in ordered]
    for n, q in (extra or {}).items():
        parts.append(f"{n} AS ({q}\n)")
    if not parts:
        return body
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body
