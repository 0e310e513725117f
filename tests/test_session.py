"""The scratch folder comes from the session's checkpoint setting; no local folder on a cluster."""

import pytest

from listenkpi.session import checkpoint_root


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, master, configured=None):
        self.master, self._conf, self._dir = master, _Conf(configured), None

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self._dir = d


class _Session:
    def __init__(self, master, configured=None):
        self.sparkContext = _Context(master, configured)


def test_cluster_without_checkpoint_dir_refuses_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session("yarn"))


def test_configured_checkpoint_dir_is_used():
    assert checkpoint_root(_Session("yarn", "hdfs://nn/shared/ckpt")) == "hdfs://nn/shared/ckpt"


def test_local_session_without_setting_gets_a_scratch_folder():
    assert checkpoint_root(_Session("local[2]"))


def test_local_cluster_without_setting_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session("local-cluster[2,1,1024]"))
