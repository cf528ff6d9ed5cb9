from __future__ import annotations

import json
import time
from datetime import datetime, timezone

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from lotwise.operators import prepare, reports
from lotwise.plans.scoring import clean_live, score_live
from lotwise.sources import messages
from lotwise.sources.standin import standin_listings
from lotwise.streaming import jobs
from lotwise.streaming.sinks import all_of, append_sink, console_sink, file_sink, read_table

NOW = {"availableNow": True}
MOMENT = datetime(2024, 5, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def listings(spark):
    return standin_listings(spark, SMALL).cache()


def send(frame, folder):
    stamped = messages.stamp_messages(frame, F.col("event_time"))
    messages.write_message_files(stamped.coalesce(1), folder)


def score(spark, folder, output, **reading):
    stream = messages.read_message_files(spark, folder, **reading)
    jobs.start_scoring(stream, output, trigger=NOW).awaitTermination()


def load(spark, folder, output, **options):
    stream = messages.read_message_files(spark, folder, max_files_per_trigger=1)
    jobs.start_loading(stream, output, trigger=NOW, **options).awaitTermination()


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_each_micro_batch_is_scored_by_itself(spark, listings, tmp_path):
    folder, output = str(tmp_path / "in"), str(tmp_path / "out")
    parts = [listings.filter(F.pmod("id", F.lit(3)) == part) for part in range(3)]
    for part in parts:
        send(part, folder)
    score(spark, folder, output, max_files_per_trigger=1)
    for batch_id, part in enumerate(parts):
        scored = score_live(clean_live(part))
        for name, alerts in reports.ALERTS.items():
            found = read_table(spark, output, name).filter(F.col("batch_id") == batch_id)
            assert same_rows(found.drop("batch_id"), alerts(scored)), (batch_id, name)
        stamped = part.withColumn("event_time", F.col("event_time").cast("timestamp"))
        summary = reports.segment_summary(prepare.standardize(stamped))
        found = read_table(spark, output, "segment_summary").filter(F.col("batch_id") == batch_id)
        assert same_rows(found.drop("batch_id"), summary)
        counts = read_table(spark, output, "batch_metrics").filter(F.col("batch_id") == batch_id)
        assert same_rows(counts.drop("batch_id"), reports.batch_metrics(summary, scored))


def test_unreadable_messages_are_counted_but_not_scored(spark, listings, tmp_path):
    folder, output = str(tmp_path / "in"), str(tmp_path / "out")
    stamped = messages.stamp_messages(listings.limit(1), F.col("event_time"))
    broken = stamped.withColumn("value", F.lit("{broken").cast("binary"))
    messages.write_message_files(broken, folder)
    score(spark, folder, output)
    counts = dict(rows(read_table(spark, output, "batch_metrics"), "metric", "value"))
    assert counts["received_rows"] == 1
    assert counts["segments"] == 1
    assert counts["great_deals"] == counts["risky_buys"] == 0


def test_a_repeated_batch_replaces_its_output(spark, listings, tmp_path):
    output = str(tmp_path / "out")
    batch = listings.withColumnRenamed("vin", "VIN")
    for _ in range(2):
        jobs.score_micro_batch(batch, 4, file_sink(output), statistics_path=f"{output}/_statistics")
    summary = read_table(spark, output, "segment_summary")
    assert rows(summary.agg(F.sum("listings_count"), F.max("batch_id"))) == [
        (listings.count(), 4)
    ]


def test_nothing_stays_cached_even_after_a_failure(spark, listings):
    def failing(frame, table, batch_id):
        raise RuntimeError("no room")

    persistent = spark.sparkContext._jsc.getPersistentRDDs
    listings.count()
    before = persistent().size()
    batch = listings.withColumnRenamed("vin", "VIN")
    with pytest.raises(RuntimeError, match="no room"):
        jobs.score_micro_batch(batch, 0, failing)
    assert persistent().size() == before


def test_an_empty_batch_writes_nothing(spark, listings):
    written = []

    def sink(frame, table, batch_id):
        written.append(table)

    empty = listings.withColumnRenamed("vin", "VIN").filter("false")
    jobs.score_micro_batch(empty, 0, sink)
    jobs.load_micro_batch(empty, 0, sink, lambda: MOMENT)
    assert written == []


def test_restart_loads_each_row_once(spark, listings, tmp_path):
    folder, output = str(tmp_path / "in"), str(tmp_path / "out")
    send(listings.filter("id % 2 = 0"), folder)
    load(spark, folder, output)
    load(spark, folder, output)
    send(listings.filter("id % 2 = 1"), folder)
    load(spark, folder, output)
    found = read_table(spark, output, "listings")
    assert same_rows(found.select("id", "price", "VIN"), listings.select("id", "price", "vin"))
    batches = rows(found.groupBy("batch_id").count().orderBy("batch_id"), "batch_id")
    assert batches == [(0,), (1,)]


def test_batches_of_a_bounded_size(spark, listings, tmp_path):
    folder, output = tmp_path / "in", str(tmp_path / "out")
    for share in (40, 400, 3, 200, 40, 2):
        send(listings.filter(F.col("id") % share == 0), str(folder))
    sizes = {path.name: path.stat().st_size for path in folder.glob("*.parquet")}
    bound = max(sizes.values()) - 1
    stream = messages.read_message_files(spark, str(folder), max_bytes_per_trigger=bound)
    query = jobs.start_loading(stream, output, trigger=NOW)
    query.awaitTermination()
    per_batch = dict(rows(read_table(spark, output, "listings").groupBy("batch_id").count()))
    assert sum(per_batch.values()) == spark.read.parquet(str(folder)).count()
    # No batch but that of the one larger file holds more than the bound.
    logged = [
        [json.loads(line)["path"].rsplit("/", 1)[1] for line in log.read_text().splitlines()[1:]]
        for log in (tmp_path / "out/_checkpoint/sources/0").iterdir()
        if log.name.isdigit()
    ]
    assert sorted(name for names in logged for name in names) == sorted(sizes)
    assert 1 < len(logged) < len(sizes)
    assert all(sum(sizes[n] for n in names) <= bound or len(names) == 1 for names in logged)
    with pytest.raises(ValueError, match="not by both"):
        messages.read_message_files(spark, str(folder), max_files_per_trigger=1, max_bytes_per_trigger=1)


def test_one_file_is_loaded_by_several_tasks(spark, settings, tmp_path):
    """A file of some megabytes, one micro-batch: each task that got rows wrote a file."""
    folder, output = tmp_path / "in", tmp_path / "out"
    made = spark.range(0, 60_000, 1, 4).selectExpr(
        "id", "sha2(cast(id as string), 512) as description", "timestamp '2024-05-01 00:00:00' as event_time"
    )
    send(made, str(folder))
    assert len(list(folder.glob("*.parquet"))) == 1
    settings(spark__sql__files__maxPartitionBytes=str(1 << 20))
    load(spark, str(folder), str(output))
    found = read_table(spark, str(output), "listings")
    assert same_rows(found.select("id", "description"), made.select("id", "description"))
    assert rows(found.select("batch_id").distinct()) == [(0,)]
    assert found.select(F.input_file_name()).distinct().count() >= 3


def test_a_new_checkpoint_keeps_earlier_rows(spark, listings, tmp_path):
    output = str(tmp_path / "out")
    for number in range(2):
        folder = str(tmp_path / f"in{number}")
        send(listings.filter(f"id % 2 = {number}"), folder)
        load(spark, folder, output, checkpoint=str(tmp_path / f"checkpoint{number}"))
    found = read_table(spark, output, "listings", with_run=True)
    assert same_rows(found.select("id", "price", "VIN"), listings.select("id", "price", "vin"))
    assert found.select("run").distinct().count() == 2


def test_console_comes_in_addition(spark, listings, tmp_path, capsys):
    output = str(tmp_path / "out")
    batch = listings.withColumnRenamed("vin", "VIN")
    jobs.score_micro_batch(batch, 0, all_of(file_sink(output), console_sink(rows=2)))
    written = read_table(spark, output, "segment_summary")
    assert written.agg(F.sum("listings_count")).first()[0] == listings.count()
    assert f"segment_summary, batch 0: 2 of {written.count()} rows" in capsys.readouterr().out


def test_latency_of_each_batch(spark, listings, tmp_path):
    folder, output = str(tmp_path / "in"), str(tmp_path / "out")
    early = listings.withColumn("event_time", F.lit("2024-04-30 23:59:58.500").cast("timestamp"))
    send(early, folder)
    load(spark, folder, output, clock=lambda: MOMENT)
    latency = read_table(spark, output, "load_latency")
    assert rows(latency, "loaded_rows", "latency_seconds", "batch_id") == [
        (listings.count(), 1.5, 0)
    ]


def test_loading_turns_nan_into_null(spark, listings, tmp_path):
    folder, output = str(tmp_path / "in"), str(tmp_path / "out")
    stamped = messages.stamp_messages(listings.limit(1), F.col("event_time"))
    sent = '{"id":1,"lat":NaN,"odometer":NaN,"VIN":NaN,"price":NaN}'
    messages.write_message_files(stamped.withColumn("value", F.lit(sent).cast("binary")), folder)
    load(spark, folder, output)
    found = read_table(spark, output, "listings")
    assert rows(found, "id", "lat", "odometer", "VIN", "price") == [(1, None, None, None, None)]


def test_console_sink_prints_each_table(spark, listings, capsys):
    batch = listings.withColumnRenamed("vin", "VIN")
    jobs.score_micro_batch(batch, 3, console_sink(rows=5))
    shown = capsys.readouterr().out
    for table in ["segment_summary", *reports.ALERTS, "batch_metrics"]:
        assert f"{table}, batch 3" in shown
    # The first summary row is the largest segment.
    summary = reports.segment_summary(prepare.standardize(listings))
    largest = reports.top_segments(summary, 1).first()
    first_row = [line for line in shown.splitlines() if line.startswith("|")][1]
    assert str(largest.listings_count) in first_row and largest.model in first_row


def test_append_sink_numbers_its_batches(spark, tmp_path):
    sink = append_sink("parquet", "path", f"{tmp_path}/")
    sink(spark.range(3), "listings", 0)
    sink(spark.range(2), "listings", 1)
    found = spark.read.parquet(str(tmp_path / "listings"))
    assert rows(found.groupBy("batch_id").count().orderBy("batch_id")) == [(0, 3), (1, 2)]


def test_a_query_stops_once_idle(spark, listings, tmp_path):
    folder, output = str(tmp_path / "in"), str(tmp_path / "out")
    send(listings, folder)
    stream = messages.read_message_files(spark, folder)
    query = jobs.start_loading(stream, output, trigger={"processingTime": "1 second"})
    jobs.await_idle(query, idle_seconds=3)
    assert not query.isActive
    assert query.exception() is None
    assert read_table(spark, output, "listings").count() == listings.count()


def test_a_failed_query_raises_while_awaited(spark, listings, tmp_path):
    folder = str(tmp_path / "in")
    send(listings.limit(5), folder)

    def failing(frame, table, batch_id):
        raise RuntimeError("no room")

    stream = messages.read_message_files(spark, folder)
    query = jobs.start_loading(stream, str(tmp_path / "out"), sink=failing, trigger={"processingTime": "1 second"})
    with pytest.raises(Exception, match="no room"):
        jobs.await_idle(query, idle_seconds=60)


def test_a_long_batch_is_not_idleness(spark, listings, tmp_path):
    """The batch takes longer than the query may be idle; a second file comes meanwhile."""
    folder, output = str(tmp_path / "in"), str(tmp_path / "out")
    send(listings.filter("id % 2 = 0"), folder)
    late = []

    def slow(frame, table, batch_id):
        file_sink(output)(frame, table, batch_id)
        if not late:
            late.append(batch_id)
            send(listings.filter("id % 2 = 1"), folder)
            time.sleep(5)

    stream = messages.read_message_files(spark, folder)
    query = jobs.start_loading(stream, output, sink=slow, trigger={"processingTime": "1 second"})
    jobs.await_idle(query, idle_seconds=2)
    assert read_table(spark, output, "listings").count() == listings.count()


def test_a_batch_is_scored_in_few_jobs(spark, listings, tmp_path):
    output = str(tmp_path / "out")
    batch = listings.withColumnRenamed("vin", "VIN").cache()
    batch.count()
    spark.sparkContext.setJobGroup("few-jobs", "one micro-batch")
    try:
        jobs.score_micro_batch(batch, 0, file_sink(output), statistics_path=f"{output}/_statistics")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-jobs")) <= 23
    batch.unpersist()


def test_lists_of_one_table_equal_lists_of_their_own(spark, listings, tmp_path):
    output = str(tmp_path / "out")
    scored = score_live(clean_live(listings.withColumnRenamed("vin", "VIN")))
    together = reports.row_alerts(scored)
    for name in reports.ROW_LISTS:
        alone = reports.ALERTS[name](scored)
        assert same_rows(reports.row_list(together, name), alone), name
    file_sink(output)(together.filter("false"), reports.ROW_ALERTS, 0)
    for name in reports.ROW_LISTS:
        empty = read_table(spark, output, name)
        assert empty.isEmpty() and empty.drop("batch_id").schema.names == reports.ALERTS[name](scored).schema.names
