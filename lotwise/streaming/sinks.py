"""Where a micro-batch puts its tables.

A sink is a function of a frame, a table name and a batch number. A batch that
runs again after a failure has the number it had before. A sink runs every frame it
gets to the end at least once, since a batch's counts are observed in its first run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import schema as S
from lotwise.operators import reports
from lotwise.operators.commits import append_once
from lotwise.operators.tables import append_table

# Where Spark notes the streaming query that a thread works for.
QUERY_ID = "sql.streaming.queryId"

# Types of the table of alerts in a file sink.
ALERT_TYPES = """id long, manufacturer string, model string, price int, Price_Z_Score double,
    Odometer_Z_Score double, Arbitrage_Value double, deal_rating string, trust_score int,
    Fraud_Flag string, Avg_Price double, run string, batch_id int, alert string"""

Sink = Callable[[DataFrame, str, int], None]


def current_run(spark: SparkSession) -> str:
    """The id of the streaming query that handles a batch now. It stays the same
    when a query starts again from its checkpoint, and is new with a new one."""
    return spark.sparkContext.getLocalProperty(QUERY_ID) or "direct"


def file_sink(root: str, format: str = "parquet", **options: str) -> Sink:
    """Each batch of each query owns one folder of each table and replaces it when
    it runs again, so every row is there once. Batch numbers begin anew with a new
    checkpoint; the query's id keeps such batches apart. The table of alerts has a
    folder for each list below that."""

    def write(frame: DataFrame, table: str, batch_id: int) -> None:
        folder = f"{root}/{table}/run={current_run(frame.sparkSession)}/batch_id={batch_id}"
        parts = ["alert"] if table == reports.ROW_ALERTS else []
        writer = frame.write.format(format).options(**options).partitionBy(*parts)
        writer.mode("overwrite").save(folder)

    return write


def append_sink(format: str, table_option: str, prefix: str = "", **options: str) -> Sink:
    """Append to warehouse tables: at least once. A batch that runs again appends
    again; its query and number are written along so that readers can tell."""

    def write(frame: DataFrame, table: str, batch_id: int) -> None:
        run = current_run(frame.sparkSession)
        numbered = frame.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id)})
        append_table(numbered, format=format, **{table_option: f"{prefix}{table}"}, **options)

    return write


def once_sink(root: str, format: str = "parquet", **options: str) -> Sink:
    """Append each batch of each query once, however often it runs. Read the tables with
    :func:`lotwise.operators.commits.read_appended`, and compact them from time to time."""

    def write(frame: DataFrame, table: str, batch_id: int) -> None:
        run = current_run(frame.sparkSession)
        numbered = frame.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id)})
        append_once(numbered, f"{root}/{table}", run, batch_id, format, **options)

    return write


def console_sink(rows: int = S.SUMMARY_TOP) -> Sink:
    """Print the first rows of each table and say how many there are: a look at the
    stream, to be used beside a sink that keeps everything."""

    def write(frame: DataFrame, table: str, batch_id: int) -> None:
        if table == reports.ROW_ALERTS:
            # In order, as a whole, before the lists: a batch's counts are observed here.
            frame.count()
            for name in reports.ROW_LISTS:
                write(reports.row_list(frame, name), name, batch_id)
            return
        total = frame.count()
        print(f"{table}, batch {batch_id}: {min(rows, total)} of {total} rows")
        frame.show(rows, truncate=False)

    return write


def all_of(*sinks: Sink) -> Sink:
    """Hand every table to each of the sinks, in order."""

    def write(frame: DataFrame, table: str, batch_id: int) -> None:
        for sink in sinks:
            sink(frame, table, batch_id)

    return write


def read_table(spark: SparkSession, root: str, table: str, *, with_run: bool = False) -> DataFrame:
    """All batches of a table of a parquet file sink, with their ``batch_id`` and, if
    asked for, the ``run`` they belong to. Lists of listings are parts of one table and
    are read from it by their names; of the others, no file is read then."""
    if table == reports.ROW_ALERTS or table in reports.ROW_LISTS:
        # A batch without alerts leaves no file to take the types from.
        found = spark.read.schema(ALERT_TYPES).parquet(f"{root}/{reports.ROW_ALERTS}")
        if table in reports.ROW_LISTS:
            found = reports.row_list(found, table, "run", "batch_id")
    else:
        found = spark.read.parquet(f"{root}/{table}")
    return found if with_run else found.drop("run")
