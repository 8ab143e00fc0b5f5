"""The shared folder comes from the session; the library never invents one."""

import pytest

from starmart.config import ensure_shared_dir, overlaps, scratch_path, shared_dir


class _Conf:
    def __init__(self, d):
        self.d = d

    def get(self, key, default=None):
        return self.d.get(key, default)


class _SC:
    def __init__(self, ckpt=None, conf=None):
        self.ckpt, self.conf = ckpt, conf or {}

    def getCheckpointDir(self):
        return self.ckpt

    def getConf(self):
        return _Conf(self.conf)

    def setCheckpointDir(self, d):
        self.ckpt = d + "/uuid"


class _Session:
    def __init__(self, sc, conf=None):
        self.sparkContext, self.conf = sc, _Conf(conf or {})


def test_unset_checkpoint_dir_raises():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session(_SC()))


def test_conf_checkpoint_dir_is_used():
    s = _Session(_SC(), {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert shared_dir(s) == "hdfs://nn/ckpt/uuid"


def test_scratch_paths_are_fresh_and_under_the_shared_dir(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark))


def test_overlapping_paths():
    assert overlaps("file:/tmp/a/", "/tmp/a") and overlaps("file:///tmp/a", "/tmp/a/b")
    assert overlaps("s3://b/x/y", "s3://b/x") and not overlaps("s3://b/xy", "s3://b/x")
    assert not overlaps("/tmp/a", "/tmp/b") and not overlaps("/tmp/ab", "/tmp/a")


def test_no_machine_local_folder_on_a_cluster():
    class Cluster(_SC):
        master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_shared_dir(_Session(Cluster()))
