"""Schema and data-quality checks (Q1-Q6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _type_name(dt: T.DataType) -> str:
    return dt.simpleString()


def schema_report(df: DataFrame, declared: T.StructType, spark: SparkSession | None = None) -> DataFrame:
    """Q1: one row per declared column whose actual type differs:
    (column, expected, actual), actual = 'Column not found' when missing.
    Extra columns are ignored.  Reads only the schema - no Spark job."""
    spark = spark or df.sparkSession
    actual = {f.name: f.dataType for f in df.schema.fields}
    rows = []
    for f in declared.fields:
        exp = _type_name(f.dataType)
        if f.name not in actual:
            rows.append((f.name, exp, "Column not found"))
        elif _type_name(actual[f.name]) != exp:
            rows.append((f.name, exp, _type_name(actual[f.name])))
    return spark.createDataFrame(rows, "column string, expected string, actual string")


def _value_counts(rows: DataFrame, declared: T.StructType) -> list[tuple[str, str, Column, Column, Column]]:
    """Per declared scalar column that ``rows`` has: name, type, and the
    aggregates rows, missing values, values that are not of the type."""
    fields = [f for f in declared.fields if f.name in rows.columns
              and not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    text = {f.name: F.col(f.name).cast("string") for f in fields}
    return [(f.name, _type_name(f.dataType), F.count(F.lit(1)), F.count_if(text[f.name].isNull()),
             F.count_if(text[f.name].isNotNull() & text[f.name].try_cast(f.dataType).isNull())) for f in fields]


def value_report(rows: DataFrame, declared: T.StructType) -> DataFrame:
    """Q1 on values: for every declared scalar column that ``rows`` has, the
    number of rows, of missing values and of values that cannot be read as
    the declared type.  One pass with partial aggregates."""
    found = [F.struct(F.lit(name).alias("column"), F.lit(kind).alias("expected"), n.alias("n"),
                      missing.alias("missing"), bad.alias("bad"))
             for name, kind, n, missing, bad in _value_counts(rows, declared)]
    return rows.agg(F.array(*found).alias("_r")).select(F.inline("_r"))


def value_findings(checks: dict[str, tuple[DataFrame, T.StructType]]) -> DataFrame:
    """Q2 on values: the columns of several tables with values that are not
    of the declared type (the rows of `value_report` with ``bad`` > 0)."""
    out = None
    for name, (df, declared) in checks.items():
        r = value_report(df, declared).where("bad > 0").select(F.lit(name).alias("table"), "*")
        out = r if out is None else out.unionByName(r)
    return out


def observed_write(df: DataFrame, path: str, declared: T.StructType | None = None, label: str | None = None,
                   expected=(0, 1, 2)) -> tuple[DataFrame | None, DataFrame | None]:
    """Write ``df`` as Parquet and count its quality on the way: returns the
    rows of `value_report` (Q1, with ``declared``) and of
    `class_distribution` (Q4 + Q6, with ``label``; classes that do not occur
    have no row, all values outside ``expected`` share the null row).

    The counts are metrics of the write itself, so no pass is added; they
    are a fixed number of numbers per column and class.  The write is a
    result stage, whose tasks count once however often they are tried."""
    spark = df.sparkSession
    fields = _value_counts(df, declared) if declared is not None else []
    metrics = [c.alias(f"{what}_{i}") for i, f in enumerate(fields) for what, c in zip(("n", "missing", "bad"), f[2:])]
    if label is not None:
        known = F.col(label).isin(*expected)
        metrics += [F.count_if(F.col(label) == F.lit(x)).alias(f"class_{i}") for i, x in enumerate(expected)]
        metrics.append(F.count_if(known.isNull() | ~known).alias("other"))
    seen = Observation()
    df.observe(seen, *metrics).write.mode("errorifexists").parquet(path)
    got = seen.get
    report = classes = None
    if declared is not None:
        rows = [(name, kind, got[f"n_{i}"], got[f"missing_{i}"], got[f"bad_{i}"])
                for i, (name, kind, *_) in enumerate(fields)]
        report = spark.createDataFrame(rows, "column string, expected string, n bigint, missing bigint, bad bigint")
    if label is not None:
        rows = [(x, got[f"class_{i}"]) for i, x in enumerate(expected)] + [(None, got["other"])]
        kind = df.schema[label].dataType.simpleString()
        classes = spark.createDataFrame([r for r in rows if r[1]], f"{label} {kind}, count bigint")
    return report, classes


def schema_check(checks: dict[str, tuple[DataFrame, T.StructType]], mode: str = "report") -> DataFrame:
    """Q2: run Q1 over several inputs.  ``mode='report'`` returns the
    findings (the reference only logs them); ``mode='fail'`` raises on any."""
    out = None
    for name, (df, schema) in checks.items():
        r = schema_report(df, schema).select(F.lit(name).alias("table"), "*")
        out = r if out is None else out.unionByName(r)
    if mode == "fail" and out is not None and out.limit(1).count() > 0:
        raise ValueError("schema check failed: " + "; ".join(
            f"{r['table']}.{r['column']}: expected {r['expected']}, got {r['actual']}" for r in out.collect()))
    return out


def require_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Q3: raise when a required column is absent (analysis time, no job)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required column(s): {', '.join(missing)}")
    return df


def label_domain(df: DataFrame, col: str = "label", expected=(0, 1, 2)) -> DataFrame:
    """Q4: one row (labels, ok): the expected labels that occur, sorted; the
    plan raises when a label outside ``expected`` occurs or an expected one
    is missing.  Distinct values are found by a grouped aggregate and only
    counted afterwards, so dirty data with very many distinct values is
    never gathered into one row."""
    exp = sorted(expected)
    exp_s = ",".join(str(x) for x in exp)
    distinct = df.groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    known = F.col("_v").isin(*exp)
    res = distinct.agg(
        F.array_join(F.array_sort(F.collect_set(F.when(known, F.col("_v").cast("string")))), ",").alias("labels"),
        F.sum(F.when(known, 0).otherwise(1)).alias("_unexpected"))
    return res.select("labels", F.when((F.col("_unexpected") == 0) & (F.col("labels") == exp_s), F.lit(True))
                      .otherwise(F.raise_error(F.concat(F.lit(f"label domain is not {{{exp_s}}}: found "),
                                                        F.col("labels"), F.lit(" plus "),
                                                        F.col("_unexpected").cast("string"),
                                                        F.lit(" other value(s)"))).cast("boolean")).alias("ok"))


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q5: every row whose key occurs more than once (keep=False).  Keys are
    counted with a partial aggregate and matched back with a semi join, so a
    hot key is never collected into one window buffer."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(*keys)
    return df.join(dup, on=keys, how="left_semi")


def class_distribution(df: DataFrame, col: str = "label") -> DataFrame:
    """Q6: rows per class."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
