"""Where the package puts tables of its own."""

from types import SimpleNamespace

import pytest

from symgrid.sources.shared import new_folder, shared_folder


def session(setting=None, checkpoint=None, master="local[2]"):
    chosen = [checkpoint]
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: chosen[-1], setCheckpointDir=lambda path: chosen.append(path)
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: setting or default), sparkContext=context)


def test_setting_of_the_session_comes_first():
    assert shared_folder(session("hdfs://nn/shared/", "/elsewhere")) == "hdfs://nn/shared"
    assert shared_folder(session(None, "s3a://bucket/checkpoints")) == "s3a://bucket/checkpoints"


def test_temporary_folder_only_in_local_mode():
    local = session()
    assert shared_folder(local) == shared_folder(local)
    assert local.sparkContext.getCheckpointDir() is None
    for master in ("yarn", "local-cluster[2,1,512]"):
        with pytest.raises(ValueError, match="Set spark.checkpoint.dir"):
            shared_folder(session(master=master))


def test_new_folders_differ():
    local = session("/shared")
    assert new_folder(local, "pages") != new_folder(local, "pages")
    assert new_folder(local, "pages").startswith("/shared/symgrid/pages-")
