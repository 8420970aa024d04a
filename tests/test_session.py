"""Checkpoint-folder rules: the session's setting wins; no local fallback on a cluster."""

import pytest

from tessera.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, values, current=None):
        self.master = master
        self._conf = _Conf(values)
        self.current = current
        self.set_to = None

    def getCheckpointDir(self):
        return self.current

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self.set_to = path
        self.current = path


class _Session:
    def __init__(self, master, values=None, current=None):
        self.sparkContext = _Context(master, values or {}, current)
        self.conf = _Conf(values or {})


def test_existing_folder_is_kept():
    s = _Session("yarn", current="/shared/ckpt/abc")
    assert ensure_checkpoint_dir(s) == "/shared/ckpt/abc"
    assert s.sparkContext.set_to is None


def test_session_setting_is_used():
    s = _Session("k8s://x", {"spark.checkpoint.dir": "/shared/checkpoints"})
    assert ensure_checkpoint_dir(s) == "/shared/checkpoints"


def test_cluster_without_setting_fails():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_local_without_setting_gets_scratch_folder():
    s = _Session("local[2]")
    assert ensure_checkpoint_dir(s) == s.sparkContext.set_to
