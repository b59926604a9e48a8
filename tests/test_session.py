from __future__ import annotations

from types import SimpleNamespace

import pytest

from medallion import session


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def stub(master, named=None):
    conf = SimpleNamespace(get=lambda key, default: named)
    return SimpleNamespace(conf=conf, sparkContext=Context(master))


def test_the_named_folder_is_used():
    assert session.shared_folder(stub("yarn", "s3a://bucket/scratch/")) == "s3a://bucket/scratch"


def test_a_cluster_without_a_named_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(stub("yarn"))


def test_a_local_session_gets_one_folder_of_its_own():
    local = stub("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)
    assert session.work_folder(local, "a").startswith(session.shared_folder(local))
