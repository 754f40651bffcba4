"""Declared table schemas (S1, S2, star schema, metric tables)."""

from pyspark.sql import types as T

_MAPS = T.ArrayType(T.MapType(T.StringType(), T.StringType()))

# Raw review table (one row per review).  `timestamp` is epoch milliseconds.
REVIEWS = T.StructType([
    T.StructField("rating", T.DoubleType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("images", _MAPS),
    T.StructField("asin", T.StringType()),
    T.StructField("parent_asin", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("verified_purchase", T.BooleanType()),
    T.StructField("helpful_vote", T.LongType()),
])

# Raw product metadata table (one row per product).
METADATA = T.StructType([
    T.StructField("main_category", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("average_rating", T.DoubleType()),
    T.StructField("rating_number", T.LongType()),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("description", T.ArrayType(T.StringType())),
    T.StructField("price", T.DoubleType()),
    T.StructField("images", _MAPS),
    T.StructField("videos", _MAPS),
    T.StructField("store", T.StringType()),
    T.StructField("categories", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("details", T.MapType(T.StringType(), T.StringType(), True)),
    T.StructField("parent_asin", T.StringType()),
    T.StructField("bought_together", T.ArrayType(T.StringType())),
])

CATEGORIES = T.StructType([
    T.StructField("category_id", T.LongType(), False),
    T.StructField("category_name", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("category_id", T.LongType()),
    T.StructField("product_title", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("parent_asin", T.StringType()),
])

STAR_REVIEWS = T.StructType([
    T.StructField("review_id", T.LongType(), False),
    T.StructField("product_id", T.LongType()),
    T.StructField("cleaned_text", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("helpful_vote", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("final_sentiment", T.StringType()),
])

DRIFT_COUNTER = T.StructType([
    T.StructField("inserted_datetime", T.TimestampType()),
    T.StructField("drift_counter", T.IntegerType()),
])

WORD_STATS = T.StructType([
    T.StructField("Feature", T.StringType()),
    T.StructField("Frequency", T.LongType()),
])

METRICS = T.StructType([
    T.StructField("Model_Name", T.StringType()),
    T.StructField("Metric", T.StringType()),
    T.StructField("Value", T.DoubleType()),
])

GROUP_METRICS = T.StructType([
    T.StructField("Model_Name", T.StringType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Metric", T.StringType()),
    T.StructField("Value", T.DoubleType()),
])
