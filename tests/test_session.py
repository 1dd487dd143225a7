from types import SimpleNamespace

import pytest

from tidemark import session


def fake(master, folder=None):
    """Just enough of a session to ask for its folder."""
    values = {"spark.checkpoint.dir": folder, "spark.master": master}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: values.get(key) or default),
                           sparkContext=SimpleNamespace(applicationId="app-1"))


def test_scratch_follows_the_shared_folder():
    path = session.scratch_dir(fake("yarn", "hdfs://shared/ckpt/"), "x")
    assert path.startswith("hdfs://shared/ckpt/tidemark/x-")
    assert path != session.scratch_dir(fake("yarn", "hdfs://shared/ckpt/"), "x")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(fake("yarn"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(fake(None), "x")


def test_a_local_session_gets_one_temporary_folder():
    first, second = (session.scratch_dir(fake("local[8]"), "x") for _ in range(2))
    assert first.split("/tidemark/")[0] == second.split("/tidemark/")[0]


def test_materialize_keeps_the_rows(spark):
    assert sorted(r["id"] for r in session.materialize(spark.range(5), "m").collect()) == list(range(5))
