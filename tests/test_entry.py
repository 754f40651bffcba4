"""The driver contract works from any working directory: queries with
Python workers (mapInPandas, applyInPandasWithState) must find the package
on the executors, not only on the driver."""

import os
import shutil
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as E
qs = E.queries()
print("e1", qs["e1_batch_scoring_arrow"](spark, "/root/testdata/sf0.001").count())
print("entry", E.entry(spark).count())
spark.stop()
"""


def test_python_worker_query_from_foreign_cwd():
    cwd = tempfile.mkdtemp(prefix="revlens-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = dict(line.split() for line in out.stdout.splitlines() if line.startswith(("e1", "entry")))
    assert int(lines["e1"]) > 0
    assert int(lines["entry"]) >= 0


def test_entry_without_training_data_operators():
    """The other queries stay when the subpackage, its tests and the pipeline
    are gone; a broken import inside the subpackage is an error, not a gap."""
    copy = tempfile.mkdtemp(prefix="revlens-copy-")
    for name in ("revlens", "__spark_entry__.py"):
        src = os.path.join(REPO, name)
        if os.path.isdir(src):
            shutil.copytree(src, os.path.join(copy, name), ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, copy)
    code = "import __spark_entry__ as E; q = E.queries(); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q))"
    run = lambda: subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120,
                                 env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    out = run()
    assert out.returncode == 0, out.stderr[-2000:]
    n, extra = out.stdout.split()[-2:]
    assert int(n) >= 90 and extra == "False"
    os.makedirs(os.path.join(copy, "revlens", "llm"))
    for name, text in (("__init__.py", ""), ("queries.py", "import no_such_module_at_all\n")):
        with open(os.path.join(copy, "revlens", "llm", name), "w") as f:
            f.write(text)
    assert run().returncode != 0
