"""The checkpoint folder: the cluster's setting, or an error off local mode."""

from types import SimpleNamespace

import pytest

from revlens.session import ensure_checkpoint_dir


def _session(master, conf=None):
    folder = {}
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: folder.get("at"),
                         setCheckpointDir=lambda p: folder.update(at=p))
    values = dict(conf or {})
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(
        get=lambda k, default=None: values.get(k, default), set=values.__setitem__))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://https://x"])
def test_missing_folder_is_an_error_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_session(master))


def test_cluster_setting_and_local_default(tmp_path):
    conf = {"spark.checkpoint.dir": "hdfs://shared/ckpt"}
    assert ensure_checkpoint_dir(_session("yarn", conf)) == "hdfs://shared/ckpt"
    for master in ("local", "local[*]", "local[8]"):
        assert ensure_checkpoint_dir(_session(master), str(tmp_path)).startswith(str(tmp_path))


def test_scratch_tables_are_released(spark):
    from revlens import session as S
    df = S.materialize(spark.range(5), "kept")
    path = S._SCRATCH[-1]
    assert df.count() == 5 and S.path_exists(spark, path)
    assert S.release_scratch(spark) >= 1 and not S._SCRATCH and not S.path_exists(spark, path)
