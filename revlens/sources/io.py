"""Readers and writers.

All readers take an explicit schema: nothing is inferred, so a scan never
runs an extra inference job and types do not drift between stages.  Between
pipeline stages nothing is written at all - the plan stays lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .commitlog import read_runs, write_run

LATIN1 = "ISO-8859-1"


# White space around a CSV value belongs to the value.
_KEEP_SPACE = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _nested_as_string(schema: T.StructType) -> T.StructType:
    """CSV cannot hold arrays/maps: read such columns as JSON text."""
    fields = []
    for f in schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            fields.append(T.StructField(f.name, T.StringType(), f.nullable))
        else:
            fields.append(f)
    return T.StructType(fields)


# Line breaks and the sign that marks them in files of one record a line.
_LINE_MARKS = [("%", "%25"), ("\n", "%0A"), ("\r", "%0D")]


def _replaced(df: DataFrame, pairs) -> DataFrame:
    """String columns with each first text of ``pairs`` as the second one."""
    def put(c: Column) -> Column:
        for old, new in pairs:
            c = F.replace(c, F.lit(old), F.lit(new))
        return c
    return df.select(*[put(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet", encoding: str | None = None, line_records: bool = False) -> DataFrame:
    """Scan a table with a declared schema.

    ``fmt`` is ``parquet`` (default), ``json`` (one object per line) or
    ``csv`` (header, multi-line quoted fields).  For CSV the nested columns of
    ``schema`` are read as JSON strings and parsed with ``from_json``.
    ``encoding`` covers the latin-1 chunked scans (S7); input splits replace
    the reference's 100 000-row chunks.  Object-store URIs (S5) are plain
    Hadoop paths.

    A quoted field may hold line breaks, so a foreign CSV file is read by one
    task.  Files that `write_table` wrote with ``line_records`` have one
    record a line and are split.
    """
    if fmt == "parquet":
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)
    if fmt == "json":
        r = spark.read.option("mode", "PERMISSIVE")
        if encoding:
            r = r.option("encoding", encoding)
        return (r.schema(schema) if schema is not None else r).json(path)
    if fmt == "csv":
        r = (spark.read.option("header", True).option("multiLine", not line_records)
             .option("escape", '"').option("mode", "PERMISSIVE").options(**_KEEP_SPACE))
        if encoding:
            r = r.option("encoding", encoding)
        df = r.csv(path) if schema is None else r.schema(_nested_as_string(schema)).csv(path)
        if line_records:
            df = _replaced(df, [(new, old) for old, new in reversed(_LINE_MARKS)])
        if schema is None:
            return df
        cols = []
        for f in schema.fields:
            if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
                cols.append(F.from_json(F.col(f.name), f.dataType).alias(f.name))
            else:
                cols.append(F.col(f.name))
        return df.select(*cols)
    raise ValueError(f"unknown format {fmt!r}")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, encoding: str | None = None,
                line_records: bool = False) -> None:
    """Bulk write.  CSV gets a header and nested columns
    serialised as JSON; Parquet keeps arrays (tokenized sets, S12) typed.

    With ``line_records`` CSV records are one line each: line breaks in
    texts are written as marks that `read_table` turns back.  Text that
    ``encoding`` has no character for fails the write."""
    w_df = df
    if fmt == "csv":
        w_df = df.select(*[
            F.to_json(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f.name)
            for f in df.schema.fields])
    if fmt == "csv" and line_records:
        w_df = _replaced(w_df, _LINE_MARKS)
    if encoding and encoding.upper().replace("_", "-") not in ("UTF-8", "UTF8"):
        w_df = w_df.select(*[F.decode(F.encode(F.col(f"`{f.name}`"), encoding), encoding).alias(f.name)
                             if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
                             for f in w_df.schema.fields])
    w = w_df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if encoding:
        w = w.option("encoding", encoding)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').options(**_KEEP_SPACE).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def append_metrics(df: DataFrame, path: str, run: str) -> int:
    """Append a run's metric rows to a table; one table per row shape,
    partitioned by model, and nothing is rewritten.  The rows become visible
    by one commit, and a run that is tried again appends them once."""
    return write_run(df, path, run, partition_by=["Model_Name"])


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed runs, with their ``run``."""
    return read_runs(spark, path)


#: Up to so many files their offsets go to every task (about 200 bytes each).
FILES_EVERYWHERE = 100_000


def file_offsets(spark: SparkSession, path: str) -> DataFrame:
    """``_pos_path, _pos_first, _pos_rows``: per Parquet file of a table the rows of the
    files before it (in path order) and its own, from the files' metadata:
    no column is read.  One row per file, so one window orders them."""
    files = (spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("_pos_path"))
                  .agg(F.count(F.lit(1)).alias("_pos_rows")))
    before = Window.orderBy("_pos_path").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("_pos_first", F.coalesce(F.sum("_pos_rows").over(before), F.lit(0)))


def read_positions(spark: SparkSession, path: str, schema: T.StructType | None = None, name: str = "row_id",
                   start: int = 0) -> DataFrame:
    """A Parquet table with ``name`` = the place of each row in the table:
    files in path order, rows as they lie in their file.

    Spark knows a row's file and its index there, also where row groups are
    split or skipped, so no row is sorted, copied or moved; a task that runs
    again gives the same numbers.  Offsets are broadcast while the number of
    files, which is counted, is at most `FILES_EVERYWHERE`; beyond that the
    planner joins them by path.  A column called ``name`` is replaced."""
    offsets = file_offsets(spark, path)
    if len(spark.read.parquet(path).inputFiles()) <= FILES_EVERYWHERE:
        offsets = F.broadcast(offsets)
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(path)
    keep = [c for c in rows.columns if c.lower() != name.lower()]
    rows = rows.select(*[F.col(f"`{c}`") for c in keep], F.col("_metadata.file_path").alias("_pos_path"),
                       F.col("_metadata.row_index").alias("_pos_index"))
    return rows.join(offsets.select("_pos_path", "_pos_first"), "_pos_path").select(
        *[F.col(f"`{c}`") for c in keep], (F.col("_pos_first") + F.col("_pos_index") + start).alias(name))


def first_rows(spark: SparkSession, path: str, n: int, schema: T.StructType | None = None) -> DataFrame:
    """The first ``n`` rows of a Parquet table in its own order
    (``nrows=``): each task keeps its own first ``n``."""
    place = "_pos_place"
    return read_positions(spark, path, schema, place).orderBy(place).limit(n).drop(place)


def bounded_scan(df: DataFrame, n: int, order_col: str = "row_id") -> DataFrame:
    """S8 for a table with an order column: its first ``n`` rows.  Plans as
    TakeOrderedAndProject: each task keeps its own top ``n``."""
    return df.orderBy(F.col(order_col)).limit(n)


def scoring_request(df: DataFrame, cols=("input_ids", "attention_mask"), batch_col: str = "batch",
                    order_col: str | None = "row_id") -> DataFrame:
    """``{"instances": [...]}`` JSON request documents, one per value of
    ``batch_col`` (a bounded batch of rows, e.g. row_id div 256).  The
    reference builds one request for all rows; a single document for the
    whole table would pass everything through one task.  Instances are in
    ``order_col`` order, so a re-run writes the same documents."""
    inst = F.struct(*[F.col(c) for c in cols])
    if order_col is None:
        lst = F.collect_list(inst)
    else:
        lst = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("_k"), inst.alias("_v")))),
                          lambda s: s["_v"])
    return (df.groupBy(batch_col)
              .agg(F.to_json(F.struct(lst.alias("instances"))).alias("request"),
                   F.count(F.lit(1)).alias("n_instances")))
