import os

import pytest

import scoreflow.session as session
from scoreflow.session import cluster_settings, ensure_checkpoint_dir, job_scratch, scratch_path


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)

    def set(self, key, value):
        self[key] = value


class _Session:
    """A session without a context, as on Spark Connect."""

    def __init__(self, **conf):
        self.conf = _Conf({k.replace("_", "."): v for k, v in conf.items()})

    @property
    def sparkContext(self):
        raise RuntimeError("no context")


def test_cluster_without_a_shared_folder_is_an_error():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", ""):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(_Session(spark_master=master))
    shared = _Session(spark_master="yarn")
    shared.conf.set("spark.checkpoint.dir", "hdfs:///shared")
    assert ensure_checkpoint_dir(shared) == "hdfs:///shared"
    assert os.path.isdir(ensure_checkpoint_dir(_Session(spark_master="local[4]")))


def test_job_scratch_goes_with_the_job(spark):
    before = scratch_path(spark, "x")
    with job_scratch(spark) as root:
        path = scratch_path(spark, "inner")
        assert path.startswith(root)
        spark.range(3).write.parquet(path)
    assert not os.path.exists(root.replace("file:", ""))
    assert os.path.dirname(scratch_path(spark, "x")) == os.path.dirname(before)


def test_cluster_settings_follow_the_shuffle():
    got = cluster_settings(2 << 40, 1000, 4)
    assert got["spark.sql.shuffle.partitions"] == "8192"
    assert cluster_settings(0, 10, 4)["spark.sql.shuffle.partitions"] == "80"


def test_nothing_is_forced_on_a_submitted_session(monkeypatch):
    calls = []

    class Builder:
        def __getattr__(self, name):
            def call(*args):
                calls.append((name, args))
                if name == "getOrCreate":
                    return _Session(spark_master="local[1]")
                return self

            return call

    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    session.build_session(master=None, shuffle_partitions=None)
    assert "master" not in {n for n, _ in calls}
    assert not any(a and a[0] == "spark.sql.shuffle.partitions" for _, a in calls)


def test_a_plain_local_session_runs_a_query(tmp_path):
    """In a process of its own, without a defaults file that names a folder."""
    import subprocess
    import sys

    code = """
from scoreflow import registry
from scoreflow.session import build_session, checkpoint_root, scratch_path

spark = build_session(master="local[2]", shuffle_partitions=2)
root = checkpoint_root(spark)
assert root and scratch_path(spark, "x").startswith(root), root
again = build_session(master="local[2]", shuffle_partitions=2)
assert checkpoint_root(again) == root
row = registry.QUERIES["auc_exact"](spark, "/root/testdata/sf0.001").first()
assert 0 < row.auc < 1, row
print("ran", root)
"""
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0 and "ran " in done.stdout, done.stderr[-3000:]
