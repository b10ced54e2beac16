"""The folder for written tables, and what happens without one."""

import pytest

from assayflow import runtime


class _Conf(dict):
    def set(self, k, v):
        self[k] = v


class _Context:
    def __init__(self, master, conf, checkpoint):
        self.master, self.conf, self.checkpoint = master, conf, checkpoint

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.checkpoint


class _Session:
    def __init__(self, master, conf=None, checkpoint=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, self.conf, checkpoint)


def test_the_named_folder_is_used():
    assert runtime.shared_dir(_Session("spark://a:1", {"spark.checkpoint.dir": "hdfs:///x/"})) == "hdfs:///x"
    assert runtime.shared_dir(_Session("yarn", checkpoint="hdfs:///y/1")) == "hdfs:///y/1"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[3,4,6144]"])
def test_a_cluster_without_a_folder_is_an_error(master):
    with pytest.raises(RuntimeError):
        runtime.shared_dir(_Session(master))


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_one_process_makes_its_own_folder_once(master):
    session = _Session(master)
    assert runtime.shared_dir(session) == runtime.shared_dir(session) and runtime.shared_dir(session).startswith("file:")


def test_tables_survive_and_keep_their_schema(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, t string")
    back = runtime.materialise(df, "check")
    assert back.schema == df.schema and sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    assert runtime._written[-1][1].startswith(runtime.shared_dir(spark) + "/assayflow-check-")
