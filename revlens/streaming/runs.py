"""Keyed tables that micro-batches add to without rewriting them.

Each batch writes only its own rows, as a run; readers merge the runs by
key.  `FAN` runs of one level are merged into one run of the next, so a row
is written again once per level: bytes per batch follow the batch, times the
logarithm of the batches, and a reader meets at most FAN - 1 runs a level.
What belongs to the table is one entry of a commit log: a batch that runs
again after its commit does nothing, one that failed before it replaces its
own files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path
from ..sources.commitlog import CommitLog

#: Runs of a level that are merged into one of the next.
FAN = 4
BATCH = "_batch"


class RunTable:
    """Rows by ``keys``.  With ``sums``, these columns add up over the
    batches (negative numbers take back) and rows without any count left
    (``sums[0]`` = 0) are gone; else the newest batch's row of a key holds."""

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], sums: list[str] | None = None,
                 fan: int = FAN):
        self.spark, self.folder, self.keys, self.sums, self.fan = spark, folder.rstrip("/"), keys, sums, fan
        self.log = CommitLog(spark, f"{self.folder}/_log")

    def _merge(self, rows: DataFrame) -> DataFrame:
        if self.sums:
            return rows.groupBy(*self.keys).agg(*[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in self.sums])
        values = [c for c in rows.columns if c not in (*self.keys, BATCH)]
        return rows.groupBy(*self.keys).agg(*[F.max_by(c, BATCH).alias(c) for c in values], F.max(BATCH).alias(BATCH))

    def _rows(self, runs: list[dict]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.folder}/{r['path']}" for r in runs])

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch writer: the batch's rows become a run, then runs of
        full levels are merged, then all of it is committed at once."""
        seen, entry = self.log.latest()
        if entry is not None and entry["batch"] >= batch_id:
            return
        old = entry["runs"] if entry else []
        rows = self._merge(batch) if self.sums else batch.withColumn(BATCH, F.lit(batch_id).cast("long"))
        runs = [*old, {"level": 0, "path": f"level-0/batch-{batch_id}"}]
        rows.write.mode("overwrite").parquet(f"{self.folder}/{runs[-1]['path']}")
        while len(tail := [r for r in runs if r["level"] == runs[-1]["level"]]) >= self.fan:
            level = tail[0]["level"] + 1
            merged = {"level": level, "path": f"level-{level}/batch-{batch_id}"}
            self._merge(self._rows(tail)).write.mode("overwrite").parquet(f"{self.folder}/{merged['path']}")
            runs = [r for r in runs if r not in tail] + [merged]
        before = self.log.entry(seen)["gone"] if seen else []
        gone = [r["path"] for r in old if r not in runs]
        if not self.log.commit({"batch": batch_id, "runs": runs, "gone": gone}, seen):
            raise RuntimeError("another writer has committed to this table")
        for path in before:  # files that readers of the entry before last used
            delete_path(self.spark, f"{self.folder}/{path}")

    def read(self) -> DataFrame:
        """The table as of the last committed batch."""
        _, entry = self.log.latest()
        if entry is None:
            raise ValueError(f"no batch is committed in {self.folder}")
        rows = self._merge(self._rows(entry["runs"]))
        return rows.where(F.col(self.sums[0]) != 0) if self.sums else rows.drop(BATCH)
