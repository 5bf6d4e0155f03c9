import pytest

from stellate.session import checkpoint_dir, lake_root


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _SC:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, conf, None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return _Conf(self._conf)

    def setCheckpointDir(self, d):
        self.dir = d


class _Spark:
    def __init__(self, master, conf=None, session_conf=None):
        self.sparkContext = _SC(master, conf or {})
        self.conf = _Conf(session_conf or {})


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError):
        checkpoint_dir(_Spark("spark://cluster:7077"))


def test_cluster_uses_configured_shared_folder():
    s = _Spark("yarn", conf={"spark.checkpoint.dir": "hdfs://nn/shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs://nn/shared/ckpt"
    assert lake_root(s) == "hdfs://nn/shared/ckpt/stellate-lake"
    s2 = _Spark("yarn", conf={"spark.checkpoint.dir": "hdfs://nn/ck"}, session_conf={"stellate.lake.root": "s3a://b/lake/"})
    assert lake_root(s2) == "s3a://b/lake"


def test_local_master_falls_back_to_a_temp_folder():
    s = _Spark("local[2]")
    assert checkpoint_dir(s).startswith("/")
