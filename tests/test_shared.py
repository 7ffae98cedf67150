"""The scratch folder is the cluster's; only a local session may make its own."""

import pytest

from tests.helpers import rows
from tidemark.shared import new_folder, shared_folder, staged


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, context, setting=None):
        self.sparkContext, self.conf = context, self
        self.setting = setting

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.setting or default


def test_the_setting_wins():
    assert shared_folder(Session(Context("yarn"), "s3a://x/y/")) == "s3a://x/y"


def test_local_fallback_is_made_once(tmp_path):
    session = Session(Context("local[4]"))
    assert shared_folder(session) == shared_folder(session)
    assert shared_folder(Session(Context("local", str(tmp_path)))) == str(tmp_path)


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(Context("yarn")))


def test_staged_rows_are_a_written_table(spark):
    df = staged(spark.range(5))
    assert rows(df) == [(i,) for i in range(5)]
    assert df.inputFiles()[0].startswith("file:")
    assert new_folder(spark, "x") != new_folder(spark, "x")
