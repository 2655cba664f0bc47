from types import SimpleNamespace

import pytest

from martlet.session import checkpoint_dir


class _Ctx:
    def __init__(self, master, ckpt=None, conf=None):
        self.master, self._ckpt, self._conf = master, ckpt, conf or {}

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d

    def getConf(self):
        return SimpleNamespace(get=lambda k, default=None: self._conf.get(k, default))


def test_cluster_without_shared_checkpoint_dir_is_an_error():
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(sparkContext=_Ctx("yarn")))


def test_checkpoint_dir_is_read_from_the_session():
    ctx = _Ctx("yarn", conf={"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert checkpoint_dir(SimpleNamespace(sparkContext=ctx)) == "hdfs://nn/ckpt"
    local = _Ctx("local[4]")
    d = checkpoint_dir(SimpleNamespace(sparkContext=local))
    assert d and local.getCheckpointDir() == d
