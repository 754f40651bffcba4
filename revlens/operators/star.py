"""Star schema and serving queries.

Surrogate keys follow first appearance in row order, as the row-by-row
inserts of the reference assign them, but are computed with grouped
aggregates and the distributed rank - no driver loop, no per-row insert.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ordering import rank_within, top_k_per_group


def epoch_ms_to_ts(col) -> "F.Column":
    """Epoch milliseconds -> UTC wall-clock time (TIMESTAMP_NTZ)
    truncated to the second; independent of the session time zone."""
    c = F.col(col) if isinstance(col, str) else col
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    secs = F.floor(c / F.lit(1000))
    return F.timestamp_add("SECOND", secs, epoch)


def category_dim(labeled: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Distinct main_category with an id in first-appearance order."""
    first = labeled.groupBy(F.col("main_category").alias("category_name")).agg(F.min(row_id).alias("_first"))
    return rank_within(first, ["_first"], name="category_id").select("category_id", "category_name")


def product_dim(labeled: DataFrame, categories: DataFrame, row_id: str = "row_id") -> DataFrame:
    """One product per (title, category); the first row's price and
    parent_asin win; id in first-appearance order."""
    g = labeled.groupBy("product_title", "main_category").agg(
        F.min(row_id).alias("_first"),
        F.min_by(F.struct("price", "parent_asin"), F.col(row_id)).alias("_v"))
    ranked = rank_within(g, ["_first"], name="product_id")
    return ranked.join(categories, ranked.main_category.eqNullSafe(categories.category_name)).select(
        "product_id", "category_id", "product_title", F.col("_v.price").alias("price"),
        F.col("_v.parent_asin").alias("parent_asin"))


FACT = ["review_id", "product_id", "cleaned_text", "rating", "helpful_vote", "timestamp", "final_sentiment"]


def review_fact(labeled: DataFrame, products: DataFrame, categories: DataFrame,
                row_id: str = "row_id", with_category: bool = False) -> DataFrame:
    """D3: reviews with product_id, second-truncated UTC timestamp and a
    review_id = 1 + position in row order (``row_id`` is unique)."""
    pk = products.join(categories, "category_id").select(
        F.col("product_id"), F.col("category_id"), F.col("product_title").alias("_title"),
        F.col("category_name").alias("_cat"))
    # ids are attached to narrow keys; the text joins last, by row id, so no
    # hot (title, category) pair moves it
    keys = labeled.select(F.col(row_id).alias("_rid"), "product_title", "main_category")
    ids = keys.join(pk, keys.product_title.eqNullSafe(pk._title) & keys.main_category.eqNullSafe(pk._cat)).select(
        "_rid", "product_id", "category_id")
    ids = rank_within(ids, ["_rid"], name="review_id")
    body = labeled.select(F.col(row_id).alias("_row"), "cleaned_text", "rating", "helpful_vote",
                          epoch_ms_to_ts(labeled["timestamp"]).alias("timestamp"), "final_sentiment")
    return ids.join(body, ids._rid == body._row).select(*FACT, *(["category_id"] if with_category else []))


def build_star(labeled: DataFrame, row_id: str = "row_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(categories, products, reviews) from a labeled review table."""
    cats = category_dim(labeled, row_id)
    prods = product_dim(labeled, cats, row_id)
    return cats, prods, review_fact(labeled, prods, cats, row_id)


def store_star(labeled: DataFrame, folder: str, row_id: str = "row_id") -> None:
    """Write the star as Parquet tables that lookups prune: products and
    reviews lie in folders by category, reviews in files sorted by id."""
    cats = category_dim(labeled, row_id)
    cats.write.parquet(f"{folder}/categories")
    cats = labeled.sparkSession.read.parquet(f"{folder}/categories")
    product_dim(labeled, cats, row_id).repartition("category_id").write.partitionBy("category_id") \
        .parquet(f"{folder}/products")
    prods = labeled.sparkSession.read.parquet(f"{folder}/products")
    # adaptive execution splits a large category over several tasks
    (review_fact(labeled, prods, cats, row_id, with_category=True).hint("rebalance", "category_id")
        .sortWithinPartitions("category_id", "product_id", "review_id")
        .write.partitionBy("category_id").parquet(f"{folder}/reviews"))


def load_star(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(categories, products, reviews) of a stored star; the last two carry
    their partition column ``category_id``."""
    products = spark.read.parquet(f"{folder}/products")
    return (spark.read.parquet(f"{folder}/categories"),
            products.select("product_id", "category_id", "product_title", "price", "parent_asin"),
            spark.read.parquet(f"{folder}/reviews"))


def list_categories(categories: DataFrame) -> DataFrame:
    """Every category with its id."""
    return categories.select("category_id", "category_name")


def products_of(products: DataFrame, category_id: int) -> DataFrame:
    """On a stored star only the category's folder is read."""
    return products.filter(F.col("category_id") == F.lit(category_id))


def product_details(products: DataFrame, reviews: DataFrame, product_id: int) -> tuple[DataFrame, DataFrame]:
    """The product row and its review rows (two filtered scans; a
    product's reviews are never gathered into one row).  The filter reaches
    the files, which are sorted by product inside each category."""
    return (products.filter(F.col("product_id") == F.lit(product_id)),
            reviews.filter(F.col("product_id") == F.lit(product_id)))


def latest_reviews(reviews: DataFrame, n: int = 5) -> DataFrame:
    """K2: the ``n`` highest review ids (top-k, no global sort)."""
    return reviews.orderBy(F.desc("review_id")).limit(n)


def reference_window(reviews: DataFrame, lo: int = 1, hi: int = 500) -> DataFrame:
    """K3: reviews with ``lo <= review_id <= hi``."""
    return reviews.filter(F.col("review_id").between(lo, hi))


def ui_subset(labeled: DataFrame, n_products: int = 5, n_reviews: int = 10, max_rows: int = 500,
              row_id: str = "row_id") -> DataFrame:
    """M7 (+W2, W3, W4, J4): categories in first-appearance order; in each,
    the first ``n_products`` products; of each, the first ``n_reviews``
    reviews; stop after the category that brings the total to ``max_rows``
    and keep the first ``max_rows`` rows of that concatenation."""
    cats = rank_within(labeled.groupBy("main_category").agg(F.min(row_id).alias("_cf")),
                       ["_cf"], name="_crank").select("main_category", "_crank")
    prods = labeled.groupBy("main_category", "product_title").agg(F.min(row_id).alias("_pf"))
    prods = top_k_per_group(prods, ["main_category"], ["_pf", "product_title"], n_products, name="_prank")
    chosen = labeled.join(prods.select("main_category", "product_title", "_prank"),
                          ["main_category", "product_title"])  # J4: semi join that keeps the rank
    revs = top_k_per_group(chosen, ["main_category", "product_title"], [row_id], n_reviews, name="_rrank")
    per_cat = revs.groupBy("main_category").agg(F.count(F.lit(1)).alias("_n")).join(cats, "main_category")
    from pyspark.sql import Window
    w = Window.orderBy("_crank").rowsBetween(Window.unboundedPreceding, -1)  # one row per category
    per_cat = per_cat.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    keep = per_cat.filter(F.col("_before") < max_rows).select("main_category", "_crank")
    out = revs.join(keep, "main_category")
    return (out.orderBy("_crank", "_prank", "_rrank").limit(max_rows)
               .drop("_crank", "_prank", "_rrank"))


def panel_sql(spark: SparkSession, reviews: DataFrame, products: DataFrame, categories: DataFrame,
              panel: str, category: str) -> DataFrame:
    """D8 through the SQL API: the star tables are DataFrame arguments and
    the category is a named parameter, so it is bound and never pasted.  The
    selected category's products are found first; only their reviews are
    aggregated."""
    shelf = """WITH shelf AS (
  SELECT p.product_id FROM {products} AS p
  LEFT SEMI JOIN (SELECT category_id FROM {categories} WHERE category_name = :category) AS mine
    ON p.category_id = mine.category_id),
mine AS (SELECT lower(v.final_sentiment) AS kind FROM {reviews} AS v LEFT SEMI JOIN shelf ON v.product_id = shelf.product_id)
"""
    ends = {"positive_percentage": "SELECT try_divide(count_if(kind = 'positive') * 100.0D, count(*)) AS positive_percentage FROM mine",
            "sentiment_summary": "SELECT kind AS final_sentiment, count(kind) AS sentiment_count FROM mine GROUP BY kind HAVING kind IS NOT NULL"}
    return spark.sql(shelf + ends[panel], args={"category": category}, reviews=reviews, products=products,
                     categories=categories)
