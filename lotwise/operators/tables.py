"""Writing tables: results, and intermediate tables that cut recomputation."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lotwise.session import new_folder


def stored(frame: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``frame`` once and return it as a scan of the written table.

    Use it where several later passes would repeat an expensive plan. The table
    lies in the shared working folder, so losing an executor loses none of it.
    """
    path = path or new_folder(frame.sparkSession, "stored")
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def overwrite_table(
    frame: DataFrame,
    target: str | None = None,
    format: str = "parquet",
    **options: str,
) -> None:
    """Replace a table. ``target`` is a path; warehouse connectors name theirs in
    ``options`` instead. A failed write raises."""
    _writer(frame, format, options).mode("overwrite").save(target)


def append_table(
    frame: DataFrame,
    target: str | None = None,
    format: str = "parquet",
    **options: str,
) -> None:
    _writer(frame, format, options).mode("append").save(target)


def _writer(frame: DataFrame, format: str, options: dict[str, str]):
    return frame.write.format(format).options(**options)
