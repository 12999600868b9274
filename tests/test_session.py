"""The shared folder of a session."""

from __future__ import annotations

import pytest

from shelfspark.session import shared_dir


class Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, path):
        self.folder = path


class Session:
    def __init__(self, master, conf=None, folder=None):
        self.conf = Conf({"spark.sql.warehouse.dir": "/w", **(conf or {})})
        self.sparkContext = Context(master, folder)


def test_the_named_folder_is_used():
    assert shared_dir(Session("spark://m:7077", {"spark.checkpoint.dir": "hdfs://n/shared/"})) == "hdfs://n/shared"
    assert shared_dir(Session("yarn", folder="hdfs://n/c")) == "hdfs://n/c"


def test_a_local_session_gets_one():
    assert shared_dir(Session("local[4]")) == "/w/_shelfspark_checkpoints"


def test_a_cluster_without_one_raises():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session("yarn"))
