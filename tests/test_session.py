"""The shared folder."""

import os

import pytest

from lawgrain import session as S


class Conf:
    def __init__(self, root):
        self.root = root

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.root


class Session:
    """Just what `shared_root` asks of a session."""

    def __init__(self, root, master, application="app-1"):
        self.conf = Conf(root)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": application})()


def test_the_cluster_names_the_folder():
    assert S.shared_root(Session("s3a://bucket/shared/", "yarn")) == "s3a://bucket/shared"
    first, second = (S.scratch_dir(Session("/shared", "yarn"), "x") for _ in range(2))
    assert first.startswith("/shared/x-") and first != second


def test_only_a_local_session_may_do_without():
    root = S.shared_root(Session(None, "local[8]"))
    assert os.path.isdir(root) and S.shared_root(Session("", "local[8]")) == root
    with pytest.raises(RuntimeError):
        S.shared_root(Session(None, "spark://host:7077"))


def test_staged_table_is_read_back_from_the_folder(spark):
    table = spark.range(10).selectExpr("id", "id % 3 AS k")
    stored = S.staged(table, "t")
    assert stored.dtypes == table.dtypes and stored.count() == 10
    assert all(S.shared_root(spark) in name for name in stored.inputFiles())
