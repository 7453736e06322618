import os
from types import SimpleNamespace

import pytest

from hubloom import session as module
from hubloom.session import RUNTIME_SETTINGS, inline, keep, scratch, shared_dir, use_folder


def session(master, folder):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder),
                           sparkContext=SimpleNamespace(master=master))


def test_shared_dir_follows_the_cluster():
    path = shared_dir(session("yarn", "s3://bucket/checkpoints/"), "x")
    assert path.startswith("s3://bucket/checkpoints/hubloom/x-")
    assert path != shared_dir(session("yarn", "s3://bucket/checkpoints/"), "x")


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]", "local[2]"])
def test_a_folder_must_be_named(monkeypatch, master):
    monkeypatch.setattr(module._Folders, "fallback", None)
    with pytest.raises(ValueError):
        shared_dir(session(master, None), "x")
    use_folder("/given")
    assert shared_dir(session(master, None), "x").startswith("/given/hubloom/x-")


def test_scratch_is_removed(spark):
    with scratch(spark):
        assert keep(spark, spark.range(5), "kept").count() == 5
        folders = [path.removeprefix("file:") for path in module._Folders.made]
        assert len(folders) == 1 and os.path.isdir(folders[0])
    assert not os.path.exists(folders[0]) and module._Folders.made is None


def test_inline_keeps_nothing(spark):
    with scratch(spark), inline():
        assert keep(spark, spark.range(5), "kept").count() == 5
        assert not module._Folders.made


def test_settings_are_applied(spark):
    assert all(spark.conf.get(k) == v for k, v in RUNTIME_SETTINGS.items())


def test_keep_nothing(spark):
    assert keep(spark, spark.range(5).where("id > 9"), "test-empty").count() == 0
