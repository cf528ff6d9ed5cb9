"""The scoring stream and the loading stream."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lotwise import schema as S
from lotwise.operators import prepare, reports
from lotwise.plans.scoring import clean_live, score_live
from lotwise.sources.messages import decode_messages, examine_messages
from lotwise.streaming.sinks import Sink, current_run, file_sink, once_sink

# Fixed value: how often the scoring stream wakes up.
EVERY_TEN_SECONDS = {"processingTime": "10 seconds"}

# Says when a batch arrived.
Clock = Callable[[], datetime | Column]

# Columns of the listing record that scoring uses.
SCORED_COLUMNS = [
    "id",
    "price",
    "year",
    "manufacturer",
    "model",
    "odometer",
    "title_status",
    "VIN",
]


def start_scoring(
    messages: DataFrame,
    output: str,
    *,
    sink: Sink | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    current_year: int = S.CURRENT_YEAR,
) -> StreamingQuery:
    """Score each micro-batch by itself; write its summary, alerts and counts.

    Statistics over segments are no streaming aggregates: they describe the
    batch alone. The default checkpoint lies inside ``output`` because batch
    numbers only mean something together with it.
    """
    sink = sink or file_sink(output)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # A folder for each query: two that share an output do not share statistics.
        path = f"{output}/_statistics/run={current_run(batch.sparkSession)}"
        score_micro_batch(batch, batch_id, sink, statistics_path=path, current_year=current_year)

    listings = decode_messages(messages, SCORED_COLUMNS)
    return _start(listings, handle, output, checkpoint, trigger)


def score_micro_batch(
    batch: DataFrame,
    batch_id: int,
    sink: Sink,
    *,
    statistics_path: str | None = None,
    current_year: int = S.CURRENT_YEAR,
) -> None:
    """The source is read once: the batch is kept while its passes run. What an
    executor loses of it is read again from the source. The summary is computed
    once too; it tells whether the batch has rows at all. All lists of listings are
    one pass and one write; their counts, and that of the volatile segments, are
    observed while they are written, behind their sorts, so that no row counts twice."""
    received = prepare.standardize(batch.select(*SCORED_COLUMNS, "event_time")).persist()
    summary = reports.segment_summary(received).persist()
    held = [received, summary]
    try:
        counts = summary.agg(*reports.received_counts()).first().asDict()
        if not counts["received_rows"]:
            return
        cleaned = clean_live(received)
        scored = score_live(cleaned, current_year=current_year, table_path=statistics_path)
        held.append(scored.persist())
        volatile = reports.volatile_segments(scored)
        held.append(volatile.persist())
        sink(reports.in_summary_order(summary), "segment_summary", batch_id)
        for name, found, wanted in (
            (reports.ROW_ALERTS, reports.row_alerts(scored), reports.alert_counts()),
            ("volatile_segments", volatile, reports.volatile_counts()),
        ):
            seen = Observation()
            sink(reports.in_alert_order(found, name).observe(seen, *wanted), name, batch_id)
            counts |= seen.get
        metrics = batch.sparkSession.createDataFrame(
            list(counts.items()), "metric string, value long"
        )
        sink(metrics.coalesce(1), "batch_metrics", batch_id)
    finally:
        for frame in reversed(held):
            frame.unpersist()


def start_loading(
    messages: DataFrame,
    output: str,
    *,
    sink: Sink | None = None,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    clock: Clock | None = None,
) -> StreamingQuery:
    """Append every listing to a table, and record how late each batch arrived."""
    sink = sink or file_sink(output)
    clock = clock or (lambda: datetime.now(timezone.utc))

    def handle(batch: DataFrame, batch_id: int) -> None:
        load_micro_batch(batch, batch_id, sink, clock)

    return _start(decode_messages(messages), handle, output, checkpoint, trigger)


def load_micro_batch(batch: DataFrame, batch_id: int, sink: Sink, clock: Clock) -> None:
    """One pass: the count and the newest timestamp are observed while writing."""
    if batch.isEmpty():
        return
    arrival = clock()
    seen = Observation()
    observed = batch.observe(
        seen,
        F.count(F.lit(1)).alias("loaded_rows"),
        F.max("event_time").alias("newest_message"),
    )
    sink(prepare.nan_to_null(observed).drop("event_time"), "listings", batch_id)
    newest = batch.sparkSession.range(1).select(
        F.lit(seen.get["loaded_rows"]).cast("long").alias("loaded_rows"),
        F.lit(seen.get["newest_message"]).cast("timestamp").alias("newest_message"),
    )
    sink(reports.with_latency(newest, arrival), "load_latency", batch_id)


def start_loading_examined(
    messages: DataFrame,
    output: str,
    *,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    format: str = "parquet",
) -> StreamingQuery:
    """Append readable messages to ``listings`` with the topic, partition and offset they
    came from, and the others to ``dead_letters``, whole and with the reason; every
    message once, also where a batch is repeated after a failure."""
    sink = once_sink(output, format)

    def handle(batch: DataFrame, batch_id: int) -> None:
        load_examined_batch(batch, batch_id, sink)

    return _start(examine_messages(messages), handle, output, checkpoint, trigger)


def load_examined_batch(batch: DataFrame, batch_id: int, sink: Sink) -> None:
    """The source is read once; without messages nothing is written."""
    kept = batch.persist()
    try:
        counts = kept.agg(F.count("*"), F.count("reason")).first()
        if counts[0] > counts[1]:
            good = kept.filter("reason is null").drop("value", "reason", "event_time")
            sink(prepare.nan_to_null(good), "listings", batch_id)
        if counts[1]:
            place = ["topic", "partition", "offset", "event_time"]
            sink(kept.filter("reason is not null").select(*place, "reason", "value"), "dead_letters", batch_id)
    finally:
        kept.unpersist()


def _start(
    listings: DataFrame,
    handle: Callable[[DataFrame, int], None],
    output: str,
    checkpoint: str | None,
    trigger: dict | None,
) -> StreamingQuery:
    return (
        listings.writeStream.outputMode("append")
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint or f"{output}/_checkpoint")
        .trigger(**(trigger or EVERY_TEN_SECONDS))
        .start()
    )


def await_idle(query: StreamingQuery, idle_seconds: float = 60, poll_seconds: float = 1) -> None:
    """Wait until a query ends, or stop it once it had nothing to read for a while."""
    last_work = time.monotonic()
    last_batch = None
    while not query.awaitTermination(poll_seconds):
        progress = query.lastProgress
        worked = progress is not None and progress.numInputRows > 0
        if query.status["isDataAvailable"] or (worked and progress.batchId != last_batch):
            last_work = time.monotonic()
            last_batch = progress.batchId if progress is not None else None
        if time.monotonic() - last_work >= idle_seconds:
            query.stop()
            return
