"""Text cleaning operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX


def strip_html_tags(df: DataFrame, src: str = "text", dst: str = "cleaned_text") -> DataFrame:
    """``dst`` = markup-free, lower-cased ``src``."""
    return df.withColumn(dst, TX.strip_html(src))


def drop_urls(df: DataFrame, col: str = "cleaned_text") -> DataFrame:
    """Drop rows whose text starts with http:// or https://; nulls stay."""
    return df.filter(~TX.is_url(col))


def drop_file_names(df: DataFrame, col: str = "cleaned_text") -> DataFrame:
    """C4: drop rows whose whole text looks like a file name (`name.ext`)."""
    return df.filter(~TX.is_file_name(col))


def drop_missing_text(df: DataFrame, col: str = "cleaned_text") -> DataFrame:
    """Drop rows whose text is null or a missing-value token."""
    return df.filter(~TX.is_missing_text(col))


def drop_blank(df: DataFrame, col: str = "text") -> DataFrame:
    """P10 as a filter: drop rows whose text is empty after trimming."""
    return df.filter(F.col(col).isNotNull() & ~TX.is_blank(col))


def drop_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows null (or NaN) in any of ``cols``."""
    return df.na.drop(subset=cols)
