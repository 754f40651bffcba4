"""Column-level expressions.  Everything here returns a `Column` built from
built-in Spark functions, so it stays inside whole-stage codegen."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add expensive columns so that each is evaluated once per row.

    Filters on a derived column are normally pushed below the projection
    that defines it, with the definition copied into the predicate: a
    regex chain or lexicon scan then runs once per predicate plus once for
    the projection.  Producing the columns from a one-element `inline`
    generator keeps them attributes of the generator's output, so
    predicates stay above it and reuse the computed values.
    """
    st = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select("*", F.inline(F.array(st)))


def fresh_name(*frames_and_name) -> str:
    """``fresh_name(df, ..., name)``: ``name``, or with a number behind it,
    so that no column of the frames is called so (case-insensitively)."""
    *frames, name = frames_and_name
    taken, out, n = {c.lower() for df in frames for c in df.columns}, name, 0
    while out.lower() in taken:
        n += 1
        out = f"{name}_{n}"
    return out
