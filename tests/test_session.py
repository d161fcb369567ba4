"""Checkpoint folder rules: read it from the session; a private folder only in
local mode; never a machine-local fallback on a cluster."""

import pytest

from ledgerline.session import CLUSTER_CONF, checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _SC:
    def __init__(self, master, conf, current=None):
        self.master, self._conf, self._dir = master, _Conf(conf), current

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self._dir = d


class _Spark:
    def __init__(self, sc):
        self.sparkContext = sc


def test_configured_folder_is_used():
    sc = _SC("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(_Spark(sc)) == "hdfs:///shared/ckpt"


def test_no_local_fallback_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Spark(_SC("spark://cluster:7077", {})))


def test_local_mode_gets_a_private_folder():
    sc = _SC("local[2]", {})
    d = checkpoint_dir(_Spark(sc))
    assert d and sc.getCheckpointDir() == d


def test_cluster_profile_sizes_partitions():
    assert int(CLUSTER_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 256 * 1024 * 1024
    assert CLUSTER_CONF["spark.sql.adaptive.skewJoin.enabled"] == "true"
