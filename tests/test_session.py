from types import SimpleNamespace

import pytest

from tagwright.session import new_folder, shared_folder


def session(master, setting=None):
    """A stand-in for a session, as the setting of a running one cannot be taken away."""
    made = []
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: made[-1] if made else None,
        setCheckpointDir=made.append,
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: setting or default), sparkContext=context)


def test_the_cluster_names_the_folder():
    assert shared_folder(session("yarn", "hdfs://shared/")) == "hdfs://shared"


def test_a_cluster_must_name_one():
    with pytest.raises(ValueError):
        shared_folder(session("yarn"))


def test_a_local_session_may_go_without():
    local = session("local[2]")
    folder = shared_folder(local)
    assert folder and shared_folder(local) == folder
    assert new_folder(local, "x") != new_folder(local, "x")
