"""Checkpoint-folder rules: the session's setting wins; only a local
session without one gets a scratch folder; a cluster without one fails."""

import pytest

from strata.config import ensure_checkpoint_dir


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Context:
    def __init__(self, master, current=None, conf=None):
        self.master, self._dir, self._conf = master, current, _Conf(conf or {})

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = path

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, sc, sql_conf=None):
        self.sparkContext, self.conf = sc, _Conf(sql_conf or {})


def test_existing_dir_is_kept():
    s = _Session(_Context("yarn", current="hdfs://nn/ckpt"))
    assert ensure_checkpoint_dir(s) == "hdfs://nn/ckpt"


def test_cluster_setting_is_used():
    s = _Session(_Context("yarn", conf={"spark.checkpoint.dir": "s3a://bucket/ckpt"}))
    assert ensure_checkpoint_dir(s) == "s3a://bucket/ckpt"
    s = _Session(_Context("k8s://x"), sql_conf={"spark.checkpoint.dir": "hdfs://nn/c"})
    assert ensure_checkpoint_dir(s) == "hdfs://nn/c"


def test_cluster_without_setting_fails():
    for master in ("spark://master:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(_Session(_Context(master)))


def test_local_without_setting_gets_scratch():
    path = ensure_checkpoint_dir(_Session(_Context("local[4]")))
    assert "strata-ckpt-" in path


def test_real_session_has_a_reliable_dir(spark):
    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
