"""The shared folder is the one the session names."""

import pytest

from rivulet import session


class Session:
    def __init__(self, **conf):
        self.conf = conf


def test_configured_folder_is_used(spark):
    named = Session(**{session.CHECKPOINT_DIR: "hdfs://shared/dir/", "spark.master": "yarn"})
    assert session.shared_dir(named) == "hdfs://shared/dir"
    assert session.shared_dir(spark) == spark.conf.get(session.CHECKPOINT_DIR)


def test_cluster_without_one_is_refused_and_local_gets_one():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(**{"spark.master": "yarn"}))
    local = Session(**{"spark.master": "local[2]"})
    assert session.shared_dir(local) == session.shared_dir(local)


def test_scratch_paths_are_never_reused(spark):
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
