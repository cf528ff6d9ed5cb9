"""Queries that need one file: it is one, but many tasks make its rows."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
import pytest
from conftest import rows
from pyspark import TaskContext

from lotwise.plans import registry

PARTS = 4
SENT = [datetime(1997, 5, 1), datetime(1998, 5, 1)]


@pytest.fixture
def folders(spark, monkeypatch, tmp_path):
    """Own listings in place of the tables'; ``region`` is the task that made the row."""
    made = [(i, "az", i % 9 or None, f"m{i % 3}", SENT[i % 2]) for i in range(200)]
    listings = spark.createDataFrame(
        made * 2, "id long, region string, price int, model string, event_time timestamp_ntz"
    ).selectExpr("*", "cast(null as string) as state")

    def stamped(batches):
        for batch in batches:
            task = [str(TaskContext.get().taskAttemptId())] * batch.num_rows
            at = batch.schema.get_field_index("region")
            yield batch.set_column(at, "region", pa.array(task))

    listings = listings.repartition(PARTS).mapInArrow(stamped, listings.schema)
    monkeypatch.setattr(registry, "standin_listings", lambda spark, sf_dir: listings)
    monkeypatch.setattr(registry, "new_folder", lambda spark, purpose: str(tmp_path / purpose))
    return tmp_path


def test_one_csv_file_is_written_from_many_tasks(spark, folders):
    found = rows(registry.src_csv_breaks(spark, ""), "id", "description")
    assert len(list((folders / "csv").glob("*.csv"))) == 1
    assert sorted(i for i, _ in found) == sorted([*range(200)] * 2)
    assert all(text.split("\n")[1:] == [f'"m{i % 3}", sold', ""] for i, text in found)
    assert len({text.split("\n")[0] for _, text in found}) == PARTS


def test_three_message_files_are_written_from_many_tasks(spark, folders):
    found = rows(registry.str_empty_batch(spark, ""), "id", "region", "model")
    assert len(list((folders / "messages").glob("*.parquet"))) == 3
    assert len(list((folders / "loaded/listings").glob("run=*/batch_id=*"))) == 2
    assert sorted((i, m) for i, _, m in found) == sorted([(i, f"m{i % 3}") for i in range(200)] * 2)
    for early in (0, 1):
        assert len({task for i, task, _ in found if i % 2 == early}) == PARTS
