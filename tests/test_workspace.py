from pathlib import Path
from types import SimpleNamespace

import pytest

from touchline.sources.workspace import clear_workspace, new_folder, pinned, shared_folder


def fake(master, named=None, context=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: named),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: context),
    )


def test_the_named_folder_is_used():
    assert shared_folder(fake("spark://host:7077", "s3://bucket/shared")) == "s3://bucket/shared"
    assert shared_folder(fake("yarn", None, "hdfs:///shared/1")) == "hdfs:///shared/1"


def test_a_cluster_without_one_fails():
    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        shared_folder(fake("yarn"))


def test_pinned(spark):
    assert new_folder(spark, "a") != new_folder(spark, "a")
    again = pinned(spark.range(5), "numbers")
    assert sorted(r.id for r in again.collect()) == [0, 1, 2, 3, 4]


def test_intermediate_tables_are_deleted(spark):
    again = pinned(spark.range(5), "gone")
    path = again.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert Path(path).exists()
    clear_workspace(spark)
    assert not Path(path).exists()


def test_a_local_session_changes_no_setting():
    session = fake("local[2]")
    session.sparkContext.applicationId = "local-1"
    assert shared_folder(session) == shared_folder(session)
    assert session.sparkContext.getCheckpointDir() is None
