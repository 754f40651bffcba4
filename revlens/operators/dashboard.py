"""Category dashboard panels over the star schema.

Every panel has two forms: ``category="X"`` is the dashboard with its
`$selected_category` parameter, ``category=None`` computes the panel for all
categories at once with ``category_name`` added to the grouping key.

Plan shape: the review fact is first aggregated by ``product_id`` (plus the
panel's own keys) - a map-side partial aggregate, so the shuffle carries at
most one row per product and key per task - and only then joined to the
product and category dimensions.  Dimension joins carry no broadcast hint:
adaptive execution switches them to broadcast joins when the measured size
of the dimension is under the broadcast threshold, and keeps a sort-merge
join when it is not.

``reviews`` may also be `review_sums`: additive partial sums by product, label
and day.  Sums of several batches (and of reviews taken back, with ``sign``
-1) add up, so panels follow appended reviews without reading old ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import rank_within, top_k_per_group


def _year(col: str):
    """Start of the year as TIMESTAMP_NTZ (UTC session time zone)."""
    return F.date_trunc("year", F.col(col)).cast("timestamp_ntz")


#: Keys and measures of `review_sums`; the first measure counts the reviews.
SUM_KEYS = ["product_id", "final_sentiment", "timestamp"]
SUMS = ["reviews", "ratings", "rating_sum", "helpful_votes"]


def review_sums(reviews: DataFrame, sign: str | None = None) -> DataFrame:
    """Partial sums that every panel can be computed from, one row per
    product, label and day.  ``sign`` names a column of 1 (added) and -1
    (taken back)."""
    by = F.lit(1) if sign is None else F.col(sign)
    rating = F.col("rating").cast("decimal(18,4)")
    return reviews.groupBy("product_id", "final_sentiment", F.to_date("timestamp").alias("timestamp")).agg(
        F.sum(by).cast("bigint").alias("reviews"),
        F.sum(F.when(F.col("rating").isNotNull(), by).otherwise(0)).cast("bigint").alias("ratings"),
        F.sum(rating * by).cast("decimal(28,4)").alias("rating_sum"),
        F.sum(F.col("helpful_vote") * by).cast("bigint").alias("helpful_votes"))


def _measure(reviews: DataFrame, name: str) -> Column:
    """A measure of a row: of one review, or of the sums it stands for."""
    if "rating_sum" in reviews.columns:
        return F.col(name)
    return {"reviews": F.lit(1), "ratings": F.col("rating").isNotNull().cast("int"),
            "rating_sum": F.col("rating").cast("decimal(18,4)"), "helpful_votes": F.col("helpful_vote")}[name]


def _dims(products: DataFrame, categories: DataFrame, category: str | None) -> DataFrame:
    cats = categories.select("category_id", "category_name")
    if category is not None:
        cats = cats.filter(F.col("category_name") == F.lit(category))
    return products.select("product_id", "category_id", "product_title", "price").join(cats, "category_id")


def star_join(reviews: DataFrame, products: DataFrame, categories: DataFrame,
              category: str | None = None) -> DataFrame:
    """Reviews JOIN products JOIN categories (row level, for ad-hoc use)."""
    return reviews.join(_dims(products, categories, category), "product_id")


def _of_category(reviews: DataFrame, products: DataFrame, categories: DataFrame, category: str | None) -> DataFrame:
    """Reviews of the selected category's products only (D8), before any
    panel aggregates them."""
    if category is None:
        return reviews
    mine = _dims(products, categories, category).select("product_id")
    return reviews.join(mine, "product_id", "left_semi")


def _keys(category):
    return [] if category is not None else ["category_name"]


def _pct(reviews, products, categories, label: str, name: str, category) -> DataFrame:
    reviews = _of_category(reviews, products, categories, category)
    per_prod = reviews.groupBy("product_id").agg(
        F.sum(F.when(F.lower("final_sentiment") == label, _measure(reviews, "reviews")).otherwise(0)).alias("_hit"),
        F.sum(_measure(reviews, "reviews")).alias("_n"))
    j = per_prod.join(_dims(products, categories, category), "product_id")
    return j.groupBy(*_keys(category)).agg(
        F.try_divide(F.sum("_hit").cast("double") * F.lit(100.0), F.sum("_n").cast("double")).alias(name))


def positive_percentage(reviews, products, categories, category=None) -> DataFrame:
    """A1: share of reviews labelled positive (case-insensitive), in percent;
    null (not an error) for a category without reviews."""
    return _pct(reviews, products, categories, "positive", "positive_percentage", category)


def neutral_percentage(reviews, products, categories, category=None) -> DataFrame:
    """A2: share of neutral reviews, in percent."""
    return _pct(reviews, products, categories, "neutral", "neutral_percentage", category)


def negative_percentage(reviews, products, categories, category=None, compat: bool = False) -> DataFrame:
    """A3: share of negative reviews.  ``compat=True`` reproduces the
    published panel, whose SQL counts neutral reviews under this title."""
    label = "neutral" if compat else "negative"
    return _pct(reviews, products, categories, label, "negative_percentage", category)


def sentiment_summary(reviews, products, categories, category=None) -> DataFrame:
    """A4: review count per lower-cased label, nulls excluded."""
    reviews = _of_category(reviews, products, categories, category)
    per_prod = (reviews.filter(F.col("final_sentiment").isNotNull())
                .groupBy("product_id", F.lower("final_sentiment").alias("final_sentiment"))
                .agg(F.sum(_measure(reviews, "reviews")).alias("_n")))
    j = per_prod.join(_dims(products, categories, category), "product_id")
    return (j.groupBy(*_keys(category), "final_sentiment")
             .agg(F.sum("_n").alias("sentiment_count")))


def yearly_sentiment(reviews, products, categories, category=None) -> DataFrame:
    """A5: per year, counts of positive / negative / neutral (case-sensitive)."""
    reviews = _of_category(reviews, products, categories, category)
    one = _measure(reviews, "reviews")
    per_prod = reviews.groupBy("product_id", _year("timestamp").alias("review_year")).agg(
        F.sum(F.when(F.col("final_sentiment") == "positive", one).otherwise(0)).alias("_p"),
        F.sum(F.when(F.col("final_sentiment") == "negative", one).otherwise(0)).alias("_n"),
        F.sum(F.when(F.col("final_sentiment") == "neutral", one).otherwise(0)).alias("_u"))
    j = per_prod.join(_dims(products, categories, category), "product_id")
    return j.groupBy(*_keys(category), "review_year").agg(
        F.sum("_p").cast("long").alias("positive_reviews"),
        F.sum("_n").cast("long").alias("negative_reviews"),
        F.sum("_u").cast("long").alias("neutral_reviews"))


def helpful_votes_top(reviews, products, categories, category=None, k: int = 10) -> DataFrame:
    """Helpful votes of positive vs negative reviews per product title,
    top ``k`` titles by positive votes (ties broken by title)."""
    reviews = _of_category(reviews, products, categories, category)
    votes = _measure(reviews, "helpful_votes")
    per_prod = reviews.groupBy("product_id").agg(
        F.sum(F.when(F.col("final_sentiment") == "positive", votes).otherwise(0)).alias("_pv"),
        F.sum(F.when(F.col("final_sentiment") == "negative", votes).otherwise(0)).alias("_nv"))
    j = per_prod.join(_dims(products, categories, category), "product_id")
    agg = j.groupBy(*_keys(category), "product_title").agg(
        F.sum("_pv").cast("long").alias("positive_helpful_votes"),
        F.sum("_nv").cast("long").alias("negative_helpful_votes"))
    ranked = top_k_per_group(agg, _keys(category),
                             [F.desc("positive_helpful_votes"), F.asc("product_title")], k, name="rank")
    return ranked.withColumn("rank", F.col("rank").cast("long"))


def top_rated_products(reviews, products, categories, category=None) -> DataFrame:
    """Average rating per product title, rounded half-up to 2 decimals
    (exact decimal arithmetic, as the SQL database does)."""
    reviews = _of_category(reviews, products, categories, category)
    per_prod = reviews.groupBy("product_id").agg(
        F.sum(_measure(reviews, "rating_sum")).alias("_s"),
        F.sum(_measure(reviews, "ratings")).alias("_n"))
    j = per_prod.join(_dims(products, categories, category), "product_id")
    agg = j.groupBy(*_keys(category), "product_title").agg(F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
    return agg.select(*_keys(category), "product_title",
                      F.round(F.try_divide(F.col("_s"), F.col("_n").cast("decimal(20,0)")), 2)
                       .cast("double").alias("average_rating"))


def price_over_time(reviews, products, categories, category=None) -> DataFrame:
    """Review-weighted average product price per review date."""
    reviews = _of_category(reviews, products, categories, category)
    per_prod = reviews.groupBy("product_id", F.to_date("timestamp").alias("date")).agg(
        F.sum(_measure(reviews, "reviews")).alias("_n"))
    j = per_prod.join(_dims(products, categories, category), "product_id")
    return j.groupBy(*_keys(category), "date").agg(
        (F.sum(F.col("price").cast("decimal(18,2)") * F.col("_n")).cast("double")
         / F.sum("_n").cast("double")).alias("avg_price"))


def review_volume(reviews, products, categories, category=None) -> DataFrame:
    """Reviews per year."""
    reviews = _of_category(reviews, products, categories, category)
    per_prod = reviews.groupBy("product_id", _year("timestamp").alias("review_year")).agg(
        F.sum(_measure(reviews, "reviews")).alias("_n"))
    j = per_prod.join(_dims(products, categories, category), "product_id")
    return j.groupBy(*_keys(category), "review_year").agg(F.sum("_n").cast("long").alias("total_reviews"))


def _label_counts(reviews, products, categories, label, category, count_name):
    reviews = _of_category(reviews, products, categories, category)
    per_prod = (reviews.filter(F.col("final_sentiment") == label)
                .groupBy("product_id").agg(F.sum(_measure(reviews, "reviews")).alias(count_name)))
    return per_prod.join(_dims(products, categories, category), "product_id").select(
        *_keys(category), "product_id", "product_title", count_name)


def most_positive_products(reviews, products, categories, category=None, k: int = 5) -> DataFrame:
    """A10 (+W1, K1): products ranked by positive reviews (case-sensitive),
    ties broken by product_id, first ``k``."""
    agg = _label_counts(reviews, products, categories, "positive", category, "positive_review_count")
    return top_k_per_group(agg, _keys(category),
                           [F.desc("positive_review_count"), F.asc("product_id")], k, name="rank"
                           ).withColumn("rank", F.col("rank").cast("long"))


def most_negative_products(reviews, products, categories, category=None) -> DataFrame:
    """A11 (+W1): every product with negative reviews, ranked by their count.
    The rank is computed without a single-task window (see ordering)."""
    agg = _label_counts(reviews, products, categories, "negative", category, "negative_review_count")
    agg = agg.withColumn("_neg", -F.col("negative_review_count"))
    return rank_within(agg, ["_neg", "product_id"], by=_keys(category), name="product_rank").drop("_neg")


def product_avg_rating(reviews, products) -> DataFrame:
    """A12 (+P19): average rating of every product, rounded half-even to 2
    decimals, 0.0 for a product without reviews."""
    per_prod = reviews.groupBy("product_id").agg(
        F.sum(_measure(reviews, "rating_sum")).alias("_s"), F.sum(_measure(reviews, "ratings")).alias("_n"))
    j = products.select("product_id").join(per_prod, "product_id", "left")
    avg = F.try_divide(F.col("_s"), F.col("_n").cast("decimal(20,0)"))
    return j.select("product_id", F.coalesce(F.bround(avg, 2).cast("double"), F.lit(0.0)).alias("avg_rating"))


def category_list(categories) -> DataFrame:
    """Distinct category names, sorted (the dashboard variable)."""
    return categories.select("category_name").distinct().orderBy("category_name")


PANELS = {
    "positive_percentage": positive_percentage,
    "neutral_percentage": neutral_percentage,
    "negative_percentage": negative_percentage,
    "sentiment_summary": sentiment_summary,
    "yearly_sentiment": yearly_sentiment,
    "helpful_votes_top": helpful_votes_top,
    "top_rated_products": top_rated_products,
    "price_over_time": price_over_time,
    "review_volume": review_volume,
    "most_positive_products": most_positive_products,
    "most_negative_products": most_negative_products,
}


def dashboard(reviews, products, categories, category: str | None = None) -> dict[str, DataFrame]:
    """Every panel for one category (or for all categories)."""
    return {name: fn(reviews, products, categories, category) for name, fn in PANELS.items()}
