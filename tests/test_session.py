from types import SimpleNamespace

import pytest

from samplyard.session import checkpoint_root, work_path


def fake(master, conf=None):
    context = SimpleNamespace(master=master, folder=None)
    context.getCheckpointDir = lambda: context.folder
    context.setCheckpointDir = lambda folder: setattr(context, "folder", folder)
    settings = {"spark.checkpoint.dir": conf} if conf else {}
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)))


def test_the_shared_folder_comes_from_the_session():
    session = fake("spark://host", "hdfs://shared/x/")
    assert checkpoint_root(session) == "hdfs://shared/x/" == session.sparkContext.folder
    assert work_path(session, "stage").startswith("hdfs://shared/x/stage-")
    assert work_path(session, "stage") != work_path(session, "stage")


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        checkpoint_root(fake("spark://host"))


def test_local_mode_makes_its_own(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    session = fake("local[2]")
    assert checkpoint_root(session) == checkpoint_root(session) == session.sparkContext.folder
