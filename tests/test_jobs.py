"""The job scripts, with files in place of the message bus."""

from __future__ import annotations

import importlib
import os
import subprocess
import sys

import pytest
from conftest import ROOT, SMALL, rows
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.plans import scoring
from lotwise.sources import files, messages
from lotwise.sources.standin import standin_listings
from lotwise.streaming.sinks import read_table


@pytest.fixture
def run_job(spark, monkeypatch):
    """Run a job script inside the test session."""

    def run(name, *arguments, **replaced):
        monkeypatch.syspath_prepend(str(ROOT / "jobs"))
        job = importlib.import_module(name)
        monkeypatch.setattr(job, "build_session", lambda app_name: spark)
        for attribute, value in replaced.items():
            monkeypatch.setattr(job, attribute, value)
        monkeypatch.setattr(sys, "argv", [name, *map(str, arguments)])
        job.main()

    return run


def test_score_batch_by_submission(spark, tmp_path):
    listings = standin_listings(spark, SMALL)
    files.write_listings_csv(listings, str(tmp_path / "csv"))
    output = tmp_path / "table"
    for _ in range(2):
        subprocess.run(
            [
                sys.executable, str(ROOT / "jobs" / "score_batch.py"),
                "--input", str(tmp_path / "csv"), "--output", str(output),
                "--work", str(tmp_path / "work"),
            ],
            env={
                **os.environ,
                "PYTHONPATH": str(ROOT),
                "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false"
                " pyspark-shell",
            },
            check=True,
            timeout=300,
            capture_output=True,
        )
    table = spark.read.parquet(str(output))
    assert table.columns == [*S.PUBLISHED_COLUMNS, "processed_at"]
    expected = scoring.published(scoring.score_batch(scoring.clean_batch(listings)))
    found, wanted = table.drop("processed_at"), expected.drop("processed_at")
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    assert list((tmp_path / "work").iterdir()) == []


def test_publish_and_load(spark, run_job, tmp_path):
    listings = standin_listings(spark, SMALL)
    files.write_listings_csv(listings, str(tmp_path / "csv"))
    folder, output = str(tmp_path / "bus"), str(tmp_path / "out")

    def write_bus(encoded, servers, topic):
        assert (servers, topic) == ("broker:9092", messages.TOPIC)
        stamped = encoded.withColumns(
            {
                "topic": F.lit(topic),
                "partition": F.lit(0),
                "offset": F.lit(0).cast("long"),
                "timestamp": F.current_timestamp(),
            }
        )
        messages.write_message_files(stamped, folder)

    def read_bus(session, servers, topic, **options):
        assert options["starting_offsets"] == "latest"
        return messages.read_message_files(session, folder)

    servers = ("--servers", "broker:9092")
    run_job("publish_messages", "--input", tmp_path / "csv", *servers, write_bus=write_bus)
    run_job(
        "load_stream", *servers, "--output", output, "--idle-seconds", 3, read_bus=read_bus
    )
    loaded = read_table(spark, output, "listings")
    complete = listings.na.drop(subset=S.REQUIRED_COLUMNS).filter("price > 500 and price < 200000")
    assert sorted(rows(loaded, "id")) == sorted(rows(complete, "id"))
    assert loaded.filter("odometer is null or title_status is null").isEmpty()

    scored = str(tmp_path / "scored")
    run_job(
        "score_stream", *servers, "--output", scored, "--every", "1 second", "--idle-seconds", 3,
        read_bus=read_bus,
    )
    received = read_table(spark, scored, "batch_metrics").filter("metric = 'received_rows'")
    assert rows(received, "value") == [(complete.count(),)]


def test_bus_options(spark, tmp_path):
    stream = messages.read_bus(
        spark, "broker:9092", max_offsets_per_trigger=5, min_partitions=2, format="rate"
    )
    assert stream.isStreaming
    frame = spark.createDataFrame([(None, bytearray(b"{}"), 1)], "key binary, value binary, x int")
    messages.write_bus(frame, "broker:9092", format="noop")
