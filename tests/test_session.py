"""Checkpoint folder rules."""

from __future__ import annotations

import pytest

from censa.session import ensure_checkpoint_dir


class _Context:
    def __init__(self, master, current=None):
        self.master, self.current = master, current

    def getCheckpointDir(self):  # noqa: N802 - Spark's name
        return self.current

    def setCheckpointDir(self, path):  # noqa: N802
        self.current = f"{path}/uuid"


class _Session:
    def __init__(self, master, current=None, conf=None):
        self.sparkContext = _Context(master, current)
        self.conf = conf or {}


def test_folder_already_set_is_kept():
    s = _Session("spark://host:7077", current="hdfs:///shared/x", conf={"spark.checkpoint.dir": "/other"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/x"


def test_cluster_without_folder_raises():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(_Session(master))


def test_setting_is_used_on_a_cluster():
    s = _Session("yarn", conf={"spark.checkpoint.dir": "hdfs:///shared"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/uuid"


def test_local_session_gets_a_folder(spark):
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark)
