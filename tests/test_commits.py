"""Commits: versions, appends that happen once, compaction, dead letters."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.operators import commits
from lotwise.sources import messages
from lotwise.streaming import jobs

AVAILABLE_NOW = {"availableNow": True}


def numbers(spark, low, high):
    return spark.range(low, high).withColumn("name", F.concat(F.lit("n"), "id"))


def ids(frame):
    return sorted(i for (i,) in rows(frame, "id"))


def test_a_failed_write_leaves_the_version_before(spark, tmp_path):
    target = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        commits.read_published(spark, target)
    assert commits.publish(numbers(spark, 0, 10), target) == 1
    reading = commits.read_published(spark, target)
    broken = numbers(spark, 0, 50).withColumn(
        "name", F.when(F.col("id") == 49, F.raise_error(F.lit("lost")).cast("string")).otherwise("x")
    )
    with pytest.raises(Exception, match="lost"):
        commits.publish(broken, target)
    assert ids(commits.read_published(spark, target)) == list(range(10))
    assert commits.publish(numbers(spark, 5, 8), target) == 2
    # One who has begun to read goes on with the old version; others see the new one.
    assert ids(reading) == list(range(10))
    assert ids(commits.read_published(spark, target)) == [5, 6, 7]
    assert ids(commits.read_published(spark, target, version=1)) == list(range(10))
    assert len(commits.remove_old_versions(spark, target)) == 2
    assert ids(commits.read_published(spark, target)) == [5, 6, 7]
    # An empty version keeps its columns.
    commits.publish(numbers(spark, 0, 0), target)
    assert commits.read_published(spark, target).columns == ["id", "name"]
    assert commits.read_published(spark, target).count() == 0


def test_two_writers_take_numbers_of_their_own(spark, tmp_path, monkeypatch):
    log = commits.Commits(spark, str(tmp_path / "table"))
    log.add({"folder": "a"})
    seen = log.numbers
    # The second writer still sees no entry when it picks its number.
    late = iter([[], [1]])
    monkeypatch.setattr(log, "numbers", lambda: next(late, seen()))
    assert log.add({"folder": "b"}) == 2
    monkeypatch.undo()
    assert [(e["number"], e["folder"]) for e in log.read()] == [(1, "a"), (2, "b")]


def test_a_sink_that_fails_after_its_write_leaves_every_row_once(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "table")
    entered = commits.Commits.add
    monkeypatch.setattr(commits.Commits, "add", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        commits.append_once(numbers(spark, 0, 5), table, "run", 0)
    monkeypatch.setattr(commits.Commits, "add", entered)
    assert commits.append_once(numbers(spark, 0, 5), table, "run", 0)
    assert not commits.append_once(numbers(spark, 0, 5), table, "run", 0)
    assert commits.append_once(numbers(spark, 5, 6), table, "other run", 0)
    assert ids(commits.read_appended(spark, table)) == [0, 1, 2, 3, 4, 5]
    assert len(commits.remove_unread(spark, table)) == 1
    assert ids(commits.read_appended(spark, table)) == [0, 1, 2, 3, 4, 5]


def test_many_small_batches_become_few_files(spark, tmp_path):
    table = str(tmp_path / "table")
    for batch in range(40):
        commits.append_once(numbers(spark, 10 * batch, 10 * batch + 10), table, "run", batch)
    reading = commits.read_appended(spark, table)
    size = commits.Commits(spark, table).size(commits.Commits(spark, table).read()[0]["folder"])
    assert commits.compact(spark, table, target_bytes=10 * size) == 40
    # A reader at work, and batches that come again or anew, beside the compaction.
    assert ids(reading) == list(range(400))
    assert not commits.append_once(numbers(spark, 390, 400), table, "run", 39)
    assert commits.append_once(numbers(spark, 400, 410), table, "run", 40)
    assert ids(commits.read_appended(spark, table)) == list(range(410))
    assert len(commits.remove_unread(spark, table)) == 40
    assert ids(commits.read_appended(spark, table)) == list(range(410))
    assert not commits.append_once(numbers(spark, 0, 10), table, "run", 0)
    data = [p for p in (tmp_path / "table").rglob("part-*.parquet")]
    assert 5 <= len(data) - len(list((tmp_path / "table").rglob("data-*"))) + 2 <= 12
    assert len(commits.Commits(spark, table).numbers()) == 2
    # A second fold keeps what the first one knew.
    commits.compact(spark, table)
    commits.remove_unread(spark, table)
    assert not commits.append_once(numbers(spark, 0, 10), table, "run", 3)
    assert ids(commits.read_appended(spark, table)) == list(range(410))


def bus(spark, values):
    at = datetime(2024, 1, 1)
    sent = [(None, v, "listings", 3, i, at) for i, v in enumerate(values)]
    return spark.createDataFrame(sent, S.MESSAGE_SCHEMA)


GOOD = [b'{"id": 1, "price": 700.0, "model": NaN, "lat": NaN}', b' {"id": 2} ', b"{}"]
BAD = {
    None: "empty",
    b"": "empty",
    b" \n": "empty",
    b"null": "no JSON object",
    b"[1, 2]": "no JSON object",
    b"not json": "no JSON object",
    b'{"id": 3': "broken or ill-typed JSON",
    b'{"id": "three"}': "broken or ill-typed JSON",
    b'{"id": 4, "lat": {"deep": 1}}': "broken or ill-typed JSON",
    b"\xff\xfe{": "no JSON object",
}


def test_each_message_is_loaded_or_kept_with_its_reason(spark, tmp_path):
    folder, output = str(tmp_path / "in"), str(tmp_path / "out")
    messages.write_message_files(bus(spark, [*GOOD, *BAD]), folder)
    for _ in range(2):
        stream = messages.read_message_files(spark, folder)
        jobs.start_loading_examined(stream, output, trigger=AVAILABLE_NOW).awaitTermination()
    good = commits.read_appended(spark, f"{output}/listings")
    assert sorted(rows(good, "offset", "id", "price", "model", "lat")) == [
        (0, 1, 700, None, None), (1, 2, None, None, None), (2, None, None, None, None),
    ]
    assert {"topic", "partition", "offset", "run", "batch_id"} <= set(good.columns)
    dead = commits.read_appended(spark, f"{output}/dead_letters")
    found = {r.offset: (None if r.value is None else bytes(r.value), r.reason) for r in dead.collect()}
    assert found == {i + len(GOOD): pair for i, pair in enumerate(BAD.items())}
    assert set(rows(dead, "topic", "partition")) == {("listings", 3)}


def test_a_load_without_bad_messages_and_one_without_any(spark, tmp_path):
    folder, output = str(tmp_path / "in"), str(tmp_path / "out")
    messages.write_message_files(bus(spark, []), folder)
    messages.write_message_files(bus(spark, GOOD), folder)
    stream = messages.read_message_files(spark, folder, max_files_per_trigger=1)
    jobs.start_loading_examined(stream, output, trigger=AVAILABLE_NOW).awaitTermination()
    assert commits.read_appended(spark, f"{output}/listings").count() == len(GOOD)
    with pytest.raises(FileNotFoundError):
        commits.read_appended(spark, f"{output}/dead_letters")
