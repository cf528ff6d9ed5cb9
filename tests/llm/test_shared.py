from __future__ import annotations

import os

import pytest

from lotwise.llm import queries, shared


@pytest.mark.parametrize(
    "path, expected",
    [
        ("/plain/folder", "/plain/folder"),
        ("file:/a/b", "/a/b"),
        ("file:///a/b", "/a/b"),
        ("s3a://bucket/a", "s3://bucket/a"),
        ("s3n://bucket/a", "s3://bucket/a"),
        ("gs://bucket/a", "gs://bucket/a"),
        ("hdfs://host:8020/a", "hdfs://host:8020/a"),
        ("abfss://box@account.net/a", "abfss://box@account.net/a"),
        ("dbfs:/a/b", "/dbfs/a/b"),
    ],
)
def test_paths_as_tasks_name_them(path, expected):
    assert shared.task_path(path) == expected


def test_other_stores_are_refused_before_any_task():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.task_path("viewfs://cluster/a")


def test_relative_and_file_folders(spark, settings, tmp_path, monkeypatch):
    settings(spark__checkpoint__dir="some-relative-folder")
    folder = shared.shared_folder(spark, "x")
    assert os.path.isabs(folder) and "/some-relative-folder/x-" in folder
    settings(spark__checkpoint__dir=f"file://{tmp_path}")
    assert shared.shared_folder(spark, "x").startswith(f"{tmp_path}/x-")
    found = queries.op1_id_planes(spark, "/root/testdata/sf0.001")
    assert found.count() == 200 and any(tmp_path.rglob("*.ids"))
