"""CSV files of one record a line, and encodings without a character."""

import pytest

from revlens.sources import io as IO

ROWS = [(1, "a\nb\r\nc", ["x\ny", "z"]), (2, "100% %0A %25 \\n \"q\", r", None), (3, None, []), (4, "plain ", ["%"])]
KIND = "id long, t string, l array<string>"


def _lines(folder):
    return sum(1 for f in folder.glob("*.csv") for _ in open(f, encoding="utf-8", newline="\n"))


def test_round_trip_in_split_files(spark, tmp_path):
    df = spark.createDataFrame(ROWS, KIND).coalesce(1)
    IO.write_table(df, f"{tmp_path}/t", fmt="csv", line_records=True)
    assert _lines(tmp_path / "t") == len(ROWS) + 1  # a header and a line each
    back = IO.read_table(spark, f"{tmp_path}/t", schema=df.schema, fmt="csv", line_records=True)
    assert sorted(map(tuple, back.collect())) == sorted(ROWS)
    many = spark.range(3000).selectExpr("id", "concat('line\n', id) as t").coalesce(1)
    IO.write_table(many, f"{tmp_path}/m", fmt="csv", line_records=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        split = IO.read_table(spark, f"{tmp_path}/m", schema=many.schema, fmt="csv", line_records=True)
        assert split.rdd.getNumPartitions() > 3
        assert sorted(split.collect()) == sorted(many.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_foreign_files_keep_quoted_breaks(spark, tmp_path):
    (tmp_path / "f.csv").write_text('id,t\n1,"a\nb %0A"\n')
    got = IO.read_table(spark, f"{tmp_path}/f.csv", schema=IO.T._parse_datatype_string("id long, t string"), fmt="csv")
    assert list(map(tuple, got.collect())) == [(1, "a\nb %0A")]


def test_characters_outside_the_encoding_fail(spark, tmp_path):
    good = spark.createDataFrame([(1, "café ü")], "id long, t string")
    IO.write_table(good, f"{tmp_path}/g", fmt="csv", encoding=IO.LATIN1)
    assert IO.read_table(spark, f"{tmp_path}/g", schema=good.schema, fmt="csv", encoding=IO.LATIN1).first().t == "café ü"
    bad = spark.createDataFrame([(1, "10 € and Ω")], "id long, t string")
    with pytest.raises(Exception, match="(?i)character"):
        IO.write_table(bad, f"{tmp_path}/b", fmt="csv", encoding=IO.LATIN1)
