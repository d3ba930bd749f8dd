"""The shared folder."""

from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest

from featloom import session


def test_configured_folder_comes_first(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")


def fake(master, folder=None):
    context = SimpleNamespace(master=master, folder=folder)
    context.getCheckpointDir = lambda: context.folder
    context.setCheckpointDir = lambda path: setattr(context, "folder", path)
    return SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default)
    )


def test_without_a_configured_folder():
    assert session.shared_folder(fake("yarn", "hdfs:/given")) == "hdfs:/given"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("yarn"))
    local = fake("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local) != ""


def test_checkpointed_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "CHECKPOINT_DIR", "spark.no.such.setting")
    written = session.checkpointed(spark.range(5).selectExpr("id", "id * 0.5D AS half"))
    assert sorted(map(tuple, written.collect())) == [(i, i * 0.5) for i in range(5)]


def test_kept_rows_are_released(spark):
    with session.kept(spark.range(5)) as rows:
        assert rows.count() == 5 and rows.is_cached
    assert not rows.is_cached


def test_scratch_is_removed(spark):
    with session.scratch_scope(spark):
        written = session.checkpointed(spark.range(5))
        path = written.inputFiles()[0].removeprefix("file:").replace("///", "/")
        assert written.count() == 5 and Path(path).exists()
    assert not Path(path).parent.exists()
    with pytest.raises(ZeroDivisionError), session.scratch_scope(spark):
        path = session.scratch_path(spark, "a")
        spark.range(3).write.parquet(path)
        1 / 0
    assert not Path(path.removeprefix("file:")).exists()
