from types import SimpleNamespace

import pytest

from lakemart import session


def fake(master, configured=None, current=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: current)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: configured), sparkContext=context)


def test_scratch_follows_the_session_and_never_a_cluster_machine():
    assert session.scratch_root(fake("yarn", "hdfs:///scratch/")) == "hdfs:///scratch"
    assert session.scratch_root(fake("yarn", None, "hdfs:///set")) == "hdfs:///set"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(fake("yarn"))
    shared = fake("local[2]", "/shared")
    assert session.scratch_path(shared, "a") != session.scratch_path(shared, "a")


def test_shuffle_width_follows_the_input():
    assert session.shuffle_partitions(0, 8) == 8
    assert session.shuffle_partitions(2**40, 8) == 4096
    assert session.shuffle_partitions(100 * 2**40, 4000) == 409_600
