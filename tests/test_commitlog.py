"""Commits of several writers and of runs that are tried again."""

import os
import threading

import pytest

from revlens.operators import drift as DR
from revlens.sources import io as IO
from revlens.sources.commitlog import CommitLog, read_latest, read_runs, write_run


def _df(spark, n):
    return spark.range(n).withColumnRenamed("id", "v")


def test_one_of_two_writers_wins(spark, tmp_path):
    log, other = CommitLog(spark, f"{tmp_path}/log"), CommitLog(spark, f"{tmp_path}/log")
    assert log.latest() == (0, None)
    assert log.commit({"run": "a"}, 0) and not other.commit({"run": "b"}, 0)
    assert log.latest() == (1, {"run": "a"}) and other.commit({"run": "b"}, 1)
    assert log.versions() == [1, 2] and log.version_of("a") == 1 and log.version_of("c") is None
    assert [f for f in os.listdir(f"{tmp_path}/log") if f.endswith(".tmp")] == []


def test_writers_side_by_side(spark, tmp_path):
    threads = [threading.Thread(target=write_run, args=(_df(spark, n + 1), f"{tmp_path}/t", f"w{n}")) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert CommitLog(spark, f"{tmp_path}/t/_log").versions() == [1, 2, 3, 4]
    assert {r.run: r["count"] for r in read_runs(spark, f"{tmp_path}/t").groupBy("run").count().collect()} == \
        {f"w{n}": n + 1 for n in range(4)}


def test_runs_tried_again(spark, tmp_path):
    base = f"{tmp_path}/t"
    # a first try that failed before its commit is neither seen nor kept
    _df(spark, 9).write.parquet(f"{base}/run=a")
    with pytest.raises(ValueError):
        read_latest(spark, base)
    assert write_run(_df(spark, 2), base, "a") == 1 and read_latest(spark, base).count() == 2
    assert write_run(_df(spark, 3), base, "b") == 2
    assert write_run(_df(spark, 7), base, "a") == 1  # committed: left alone
    assert read_latest(spark, base).count() == 3


def test_statistics_and_metrics(spark, tmp_path):
    stats = spark.createDataFrame([("a", 1)], "Feature string, Frequency long")
    for run in ("one", "one", "two"):
        DR.save_statistics(stats, f"{tmp_path}/s", run)
    assert DR.latest_statistics(spark, f"{tmp_path}/s").count() == 1
    rows = spark.createDataFrame([("m", "acc", 0.5), ("n", "acc", 0.6)], "Model_Name string, Metric string, Value double")
    for run in ("one", "two", "two"):
        IO.append_metrics(rows, f"{tmp_path}/m", run)
    assert sorted((r.run, r.Model_Name) for r in IO.read_metrics(spark, f"{tmp_path}/m").collect()) == \
        [("one", "m"), ("one", "n"), ("two", "m"), ("two", "n")]
