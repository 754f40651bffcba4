"""SparkSession defaults and shared-storage helpers."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the operators rely on.  Everything else is left to the
# cluster's defaults so a deployment can size shuffle partitions, executor
# memory and broadcast thresholds for its own data volume.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "revlens",
                shuffle_partitions: int | None = None,
                checkpoint_dir: str | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset and let spark-submit decide.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only in local mode (one JVM, so every
    folder is shared) and when it is unset is a fresh folder under
    ``fallback`` (or the system temp folder) created and registered; on a
    cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master or ""):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = fallback or os.environ.get("TMPDIR", "/tmp")
    path = os.path.join(base, f"revlens-ckpt-{uuid.uuid4().hex[:8]}")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared checkpoint folder (never machine-local
    on a cluster) for tables an operator materialises to cut lineage."""
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def release_scratch(spark: SparkSession) -> int:
    """Delete the tables that operators of this process have written to the
    shared folder; call it when no result that reads them is needed any
    more.  Returns how many paths were released."""
    done = 0
    while _SCRATCH:
        delete_path(spark, _SCRATCH.pop())
        done += 1
    return done


def release(*tables) -> None:
    """Delete tables of ``materialize`` that nothing reads any more."""
    for df in tables:
        for folder in {f.rsplit("/", 2)[-2] for f in df.inputFiles()}:
            for path in [x for x in _SCRATCH if x.endswith(f"/{folder}")]:
                delete_path(df.sparkSession, path)
                _SCRATCH.remove(path)


def materialize(df, name: str = "table", tidy: bool = False):
    """Write ``df`` once as a Parquet table in the shared checkpoint folder
    and continue from the written copy.

    Cuts the lineage of an expensive table that several branches reuse and
    survives executor loss (unlike a local checkpoint).  Unlike an RDD
    checkpoint, the plan runs once (a checkpoint computes it again to save
    it) and later scans of the copy prune columns and push filters.
    ``tidy``: the shuffle files of this write go as soon as it has ended."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true" if tidy else before)
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        spark.conf.set(setting, before)
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that an operator wrote in the shared folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (batch scorer,
    streaming state function), as ``--py-files`` would: a zip of it is added
    to the job once per application and Spark copies it to every executor.
    Needed when the driver imports the package from a path the workers do
    not share."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="revlens-pyfiles-")
    archive = shutil.make_archive(os.path.join(out, "revlens"), "zip",
                                  root_dir=os.path.dirname(pkg), base_dir=os.path.basename(pkg))
    sc.addPyFile(archive)
    _SHIPPED.add(app)
