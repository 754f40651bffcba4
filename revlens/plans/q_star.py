"""Registered star-schema and serving queries (D1-D6, D8 via SQL parameters,
M7, K2, K3) over the labeled text reviews."""

from __future__ import annotations

from ..operators import star as ST
from ..session import materialize, path_exists, scratch_path
from .catalog import register
from .q_pipeline import _L6_CTES, _l6, _l6_spread
from .sqltext import majority_sql
from .sqlviews import with_views

SELECTED_CATEGORY = "PROMO"

_STAR_CTES = {
    **_L6_CTES,
    "l6": f"""SELECT *, {majority_sql('heuristic_sentiment', 'lexicon_a_sentiment', 'lexicon_b_sentiment')}
  AS final_sentiment FROM labeled""",
    "cats": """SELECT CAST(row_number() OVER (ORDER BY min(row_id)) AS BIGINT) AS category_id,
  main_category AS category_name FROM l6 GROUP BY main_category""",
    "pgroups": """SELECT product_title, main_category, min(row_id) AS first_row,
  arg_min(price, row_id) AS price, arg_min(parent_asin, row_id) AS parent_asin
  FROM l6 GROUP BY product_title, main_category""",
    "prods": """SELECT CAST(row_number() OVER (ORDER BY g.first_row) AS BIGINT) AS product_id, c.category_id,
  g.product_title, g.price, g.parent_asin
  FROM pgroups g JOIN cats c ON g.main_category IS NOT DISTINCT FROM c.category_name""",
    "fact": """SELECT CAST(row_number() OVER (ORDER BY l.row_id) AS BIGINT) AS review_id, p.product_id,
  l.cleaned_text, l.rating, l.helpful_vote, date_trunc('second', make_timestamp(l.timestamp * 1000)) AS timestamp,
  l.final_sentiment
  FROM l6 l JOIN cats c ON l.main_category IS NOT DISTINCT FROM c.category_name
  JOIN prods p ON p.category_id = c.category_id AND p.product_title IS NOT DISTINCT FROM l.product_title""",
}
_SRC = ("raw_reviews_v", "raw_metadata_v")


def _sql(body):
    return with_views(body, *_SRC, extra=_STAR_CTES)


def _labeled(spark, sf):
    return materialize(_l6_spread(spark, sf))


def _star(spark, sf):
    return ST.build_star(_labeled(spark, sf))


_FOLDERS: dict[tuple[str, str], str] = {}


def _stored(spark, sf):
    """The star of a table folder, written once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FOLDERS or not path_exists(spark, _FOLDERS[key]):
        folder = scratch_path(spark, "star")
        ST.store_star(_labeled(spark, sf), folder)
        _FOLDERS[key] = folder
    return ST.load_star(spark, _FOLDERS[key])


@register("d1_category_dim", _sql("SELECT * FROM cats"))
def d1(spark, sf):
    """Category dimension, ids in first-appearance order."""
    return ST.category_dim(_l6(spark, sf))


@register("d2_product_dim", _sql("SELECT * FROM prods"))
def d2(spark, sf):
    """Product dimension deduplicated on (title, category)."""
    lab = _labeled(spark, sf)
    return ST.product_dim(lab, ST.category_dim(lab))


@register("d3_review_fact", _sql("SELECT * FROM fact"))
def d3(spark, sf):
    """D3 + P15: review fact with product ids and second-truncated timestamps."""
    return _star(spark, sf)[2]


@register("d4_category_list", _sql("SELECT * FROM cats"))
def d4(spark, sf):
    """The stored category list."""
    return ST.list_categories(_stored(spark, sf)[0])


@register("d5_products_of_category", _sql("SELECT * FROM prods WHERE category_id = 1"))
def d5(spark, sf):
    """Products of category 1, from its folder alone."""
    return ST.products_of(_stored(spark, sf)[1], 1)


@register("d6_product_reviews", _sql("SELECT * FROM fact WHERE product_id = 1"))
def d6(spark, sf):
    """The reviews of product 1 (row form, never one collected row)."""
    _, prods, revs = _stored(spark, sf)
    return ST.product_details(prods, revs, 1)[1].select(*ST.FACT)


@register("k2_latest_reviews", _sql("SELECT * FROM fact ORDER BY review_id DESC LIMIT 5"))
def k2(spark, sf):
    """K2: the five latest reviews."""
    return ST.latest_reviews(_stored(spark, sf)[2], 5).select(*ST.FACT)


@register("k3_reference_window", _sql("SELECT * FROM fact WHERE review_id BETWEEN 1 AND 500"))
def k3(spark, sf):
    """K3: reviews 1..500 (drift reference window)."""
    return ST.reference_window(_stored(spark, sf)[2], 1, 500).select(*ST.FACT)


@register("d8_panel_sql_param", _sql(f"""SELECT 100.0 * n[1]::DOUBLE / n[2]::DOUBLE AS positive_percentage
FROM (SELECT list(c ORDER BY k) AS n FROM (
  SELECT 1 AS k, count(*) AS c FROM fact WHERE product_id IN (SELECT product_id FROM mine) AND final_sentiment = 'positive'
  UNION ALL SELECT 2, count(*) FROM fact WHERE product_id IN (SELECT product_id FROM mine)))""").replace(
    ",\nfact AS", f""",
mine AS (SELECT product_id FROM prods WHERE category_id = (SELECT category_id FROM cats
  WHERE category_name = '{SELECTED_CATEGORY}')),
fact AS""", 1))
def d8(spark, sf):
    """A dashboard panel run through spark.sql with a named parameter."""
    cats, prods, revs = _stored(spark, sf)
    return ST.panel_sql(spark, revs, prods, cats, "positive_percentage", SELECTED_CATEGORY)


_M7 = """
, cat_first AS (SELECT main_category, min(row_id) AS cf FROM l6 GROUP BY main_category)
, crank AS (SELECT main_category, row_number() OVER (ORDER BY cf) AS crank FROM cat_first)
, pf AS (SELECT main_category, product_title, min(row_id) AS pf FROM l6 GROUP BY main_category, product_title)
, prank AS (SELECT * FROM (SELECT main_category, product_title,
     row_number() OVER (PARTITION BY main_category ORDER BY pf, product_title) AS prank FROM pf) t WHERE prank <= 5)
, revs AS (SELECT * FROM (SELECT l.*, p.prank,
     row_number() OVER (PARTITION BY l.main_category, l.product_title ORDER BY l.row_id) AS rrank
     FROM l6 l JOIN prank p ON l.main_category = p.main_category AND l.product_title = p.product_title) t
   WHERE rrank <= 10)
, percat AS (SELECT r.main_category, c.crank, COUNT(*) AS n FROM revs r JOIN crank c
     ON r.main_category = c.main_category GROUP BY r.main_category, c.crank)
, keep AS (SELECT main_category, crank FROM (SELECT *, coalesce(SUM(n) OVER (ORDER BY crank
     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM percat) t WHERE before < 500)
SELECT r.* EXCLUDE (prank, rrank) FROM revs r JOIN keep k ON r.main_category = k.main_category
ORDER BY k.crank, r.prank, r.rrank LIMIT 500"""


@register("m7_ui_subset", _sql("__M7__").replace("\n__M7__", _M7))
def m7(spark, sf):
    """M7 + W2 + W3 + W4 + J4: first 5 products per category, first 10
    reviews each, stop at 500 rows."""
    return ST.ui_subset(_labeled(spark, sf))
