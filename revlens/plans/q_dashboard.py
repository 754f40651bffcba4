"""Registered dashboard queries (A1-A12, A17, J2, D8) over the star views."""

from __future__ import annotations

from ..operators import dashboard as D
from ..sources import testdata as td
from .catalog import register
from .sqlviews import with_views

STAR = ("reviews_v", "products_v", "categories_v")
# Category used by the single-category (parameterised) dashboard forms.
SELECTED_CATEGORY = "PROMO"

# Oracle views: products with their category's name, and review counts per
# product, so that most panels aggregate before they join.
_SHELF = {"shelf": "SELECT product_id, product_title, price, category_name FROM products_v JOIN categories_v USING (category_id)"}
_TALLY = {**_SHELF, "tally": """SELECT product_id, count(*) AS reviews,
    count(*) FILTER (lower(final_sentiment) = 'positive') AS positive,
    count(*) FILTER (lower(final_sentiment) = 'neutral') AS neutral,
    count(*) FILTER (lower(final_sentiment) = 'negative') AS negative
  FROM reviews_v GROUP BY product_id"""}


def _star(spark, sf):
    return td.review_facts(spark, sf), td.products(spark, sf), td.categories(spark, sf)


def _pct_sql(label, name):
    return with_views(f"""SELECT category_name, sum({label})::DOUBLE * 100.0 / sum(reviews)::DOUBLE AS {name}
FROM tally JOIN shelf USING (product_id) GROUP BY ALL""", *STAR, extra=_TALLY)


@register("a1_positive_percentage", _pct_sql("positive", "positive_percentage"))
def a1(spark, sf):
    """A1: positive share per category."""
    return D.positive_percentage(*_star(spark, sf))


@register("a2_neutral_percentage", _pct_sql("neutral", "neutral_percentage"))
def a2(spark, sf):
    """A2: neutral share per category."""
    return D.neutral_percentage(*_star(spark, sf))


@register("a3_negative_percentage", _pct_sql("negative", "negative_percentage"))
def a3(spark, sf):
    """A3: negative share per category (the published panel computes neutral)."""
    return D.negative_percentage(*_star(spark, sf))


@register("a4_sentiment_summary", with_views("""SELECT category_name, kind AS final_sentiment, n AS sentiment_count
FROM (SELECT category_name, sum(positive)::BIGINT AS positive, sum(neutral)::BIGINT AS neutral,
             sum(negative)::BIGINT AS negative FROM tally JOIN shelf USING (product_id) GROUP BY ALL)
UNPIVOT (n FOR kind IN (positive, neutral, negative)) WHERE n > 0""", *STAR, extra=_TALLY))
def a4(spark, sf):
    """A4: label histogram per category."""
    return D.sentiment_summary(*_star(spark, sf))


def _yearly_sql(where=""):
    return with_views(f"""SELECT category_name, date_trunc('year', timestamp) AS review_year,
  count(*) FILTER (final_sentiment = 'positive') AS positive_reviews,
  count(*) FILTER (final_sentiment = 'negative') AS negative_reviews,
  count(*) FILTER (final_sentiment = 'neutral') AS neutral_reviews
FROM shelf JOIN reviews_v USING (product_id) {where} GROUP BY ALL""", *STAR, extra=_SHELF)


@register("a5_yearly_sentiment", _yearly_sql())
def a5(spark, sf):
    """A5: yearly sentiment counts per category (flagship query)."""
    return D.yearly_sentiment(*_star(spark, sf))


@register("a6_helpful_votes_top10", with_views("""SELECT *, row_number() OVER best AS rank
FROM (SELECT category_name, product_title,
        coalesce(sum(helpful_vote) FILTER (final_sentiment = 'positive'), 0)::BIGINT AS positive_helpful_votes,
        coalesce(sum(helpful_vote) FILTER (final_sentiment = 'negative'), 0)::BIGINT AS negative_helpful_votes
      FROM reviews_v JOIN shelf USING (product_id) GROUP BY ALL)
WINDOW best AS (PARTITION BY category_name ORDER BY positive_helpful_votes DESC, product_title)
QUALIFY rank <= 10""",
                                             *STAR, extra=_SHELF))
def a6(spark, sf):
    """Top-10 product titles by helpful votes of positive reviews."""
    return D.helpful_votes_top(*_star(spark, sf))


@register("a7_top_rated_products", with_views("""SELECT category_name, product_title,
  floor((2 * tenths + 100 * n) / (200 * n))::DOUBLE / 100.0 AS average_rating
FROM (SELECT category_name, product_title, sum(round(rating * 10000)::BIGINT) AS tenths, count(rating) AS n
      FROM reviews_v JOIN shelf USING (product_id) GROUP BY ALL)""", *STAR, extra=_SHELF))
def a7(spark, sf):
    """Average rating per product title, 2 decimals half-up."""
    return D.top_rated_products(*_star(spark, sf))


@register("a8_price_over_time", with_views("""SELECT category_name, date,
  sum(price::DECIMAL(18,2) * n)::DOUBLE / sum(n)::DOUBLE AS avg_price
FROM (SELECT product_id, timestamp::DATE AS date, count(*) AS n FROM reviews_v GROUP BY ALL)
JOIN shelf USING (product_id) GROUP BY ALL""", *STAR, extra=_SHELF))
def a8(spark, sf):
    """Review-weighted average price per review date."""
    return D.price_over_time(*_star(spark, sf))


@register("a9_review_volume", with_views("""SELECT category_name, review_year, sum(n)::BIGINT AS total_reviews
FROM (SELECT product_id, date_trunc('year', timestamp) AS review_year, count(*) AS n FROM reviews_v GROUP BY ALL)
JOIN shelf USING (product_id) GROUP BY ALL""", *STAR, extra=_SHELF))
def a9(spark, sf):
    """Yearly review volume per category."""
    return D.review_volume(*_star(spark, sf))


def _label_rank_sql(label, count_name, rank_name, limit):
    top = f"QUALIFY {rank_name} <= {limit}" if limit else ""
    return with_views(f"""SELECT category_name, product_id, product_title, {label} AS {count_name},
  row_number() OVER (PARTITION BY category_name ORDER BY {label} DESC, product_id) AS {rank_name}
FROM tally JOIN shelf USING (product_id) WHERE {label} > 0 {top}""", *STAR, extra=_TALLY)


@register("a10_most_positive_products", _label_rank_sql("positive", "positive_review_count", "rank", 5))
def a10(spark, sf):
    """A10: top-5 products by positive reviews per category."""
    return D.most_positive_products(*_star(spark, sf))


@register("a11_most_negative_products", _label_rank_sql("negative", "negative_review_count", "product_rank", None))
def a11(spark, sf):
    """All products ranked by negative reviews per category."""
    return D.most_negative_products(*_star(spark, sf))


@register("a12_product_avg_rating", with_views("""SELECT product_id,
  CASE WHEN n = 0 THEN 0.0 ELSE CAST(f + CASE WHEN 2 * rem > 100 * n THEN 1 WHEN 2 * rem < 100 * n THEN 0
                                          ELSE f % 2 END AS DOUBLE) / 100.0 END AS avg_rating
FROM (SELECT product_id, n, s, f, s - f * 100 * n AS rem
      FROM (SELECT product_id, n, s, CASE WHEN n = 0 THEN 0 ELSE CAST(floor(s / (100 * n)) AS BIGINT) END AS f
            FROM (SELECT p.product_id, COUNT(r.rating) AS n,
                         coalesce(SUM(CAST(round(r.rating * 10000) AS BIGINT)), 0) AS s
                  FROM products_v p LEFT JOIN reviews_v r ON p.product_id = r.product_id
                  GROUP BY p.product_id) a) b) c""", *STAR))
def a12(spark, sf):
    """Average rating of every product (0.0 without reviews)."""
    rv, pr, _ = _star(spark, sf)
    return D.product_avg_rating(rv, pr)


@register("a17_category_list", with_views("SELECT DISTINCT category_name FROM categories_v", "categories_v"))
def a17(spark, sf):
    """Sorted distinct category names."""
    return D.category_list(td.categories(spark, sf))


@register("d8_dashboard_one_category", _yearly_sql(f"WHERE category_name = '{SELECTED_CATEGORY}'"))
def d8(spark, sf):
    """A panel for one selected category (the dashboard parameter)."""
    return D.yearly_sentiment(*_star(spark, sf), category=SELECTED_CATEGORY).selectExpr(
        f"'{SELECTED_CATEGORY}' AS category_name", "*")
