"""Files that tasks write and read themselves, in the folder all executors share.

A task may run twice, so every attempt writes under a name of its own, and only
the names that the finished task returns are ever read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.session import new_folder

# Rows leave a Python task in batches of about this many bytes.
BATCH_BYTES = 4 << 20


# How Spark and the tasks' own file systems name the same store.
TASK_SCHEMES = {
    "s3a": "s3",
    "s3n": "s3",
    "s3": "s3",
    "gs": "gs",
    "hdfs": "hdfs",
    "abfs": "abfs",
    "abfss": "abfss",
}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for task files, by a name that tasks understand on every executor.

    Spark's own file system resolves it first, so a relative folder means the same
    to tasks as to Spark."""
    return task_path(qualified(spark, new_folder(spark, purpose)))


def qualified(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(folder).toString()


def task_path(path: str) -> str:
    """The name tasks use for a path that Spark has resolved; raises where they cannot
    write to such a store."""
    scheme, colon, rest = path.partition(":")
    if not colon:
        return path
    if scheme == "file":
        return "/" + rest.lstrip("/")
    if scheme == "dbfs":
        return "/dbfs/" + rest.lstrip("/")
    if scheme not in TASK_SCHEMES:
        known = ", ".join(["file", "dbfs", *TASK_SCHEMES])
        raise ValueError(f"tasks cannot write to {path}: set spark.checkpoint.dir to one of {known}")
    return f"{TASK_SCHEMES[scheme]}:{rest}"


def locate(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


def own_name(folder: str, stem: str, suffix: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


def create(path: str):
    files, name = locate(path)
    files.create_dir(name.rsplit("/", 1)[0], recursive=True)
    # Else a name that ends in .zst would be compressed again.
    return files.open_output_stream(name, compression=None)


def open_stream(path: str):
    files, name = locate(path)
    return files.open_input_stream(name, compression=None)


def open_file(path: str):
    files, name = locate(path)
    return files.open_input_file(name)


def batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded size from an iterator of row tuples."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, (str, bytes)))
        if size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def byte_slices(batch: pa.RecordBatch, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes, at least one row each."""
    per_row = max(1, batch.nbytes // max(1, batch.num_rows))
    step = max(1, limit // per_row)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    arrays = [pa.array(list(values), kind) for values, kind in zip(columns, schema.types)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def table_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text"):
    """A text column in which null is the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def without(frame: DataFrame, *names: str) -> list[str]:
    """The frame's columns but for those of the given names, in whatever case."""
    gone = {name.lower() for name in names}
    return [name for name in frame.columns if name.lower() not in gone]


def free_name(frame: DataFrame, stem: str) -> str:
    """A column name the frame does not have."""
    taken = {name.lower() for name in frame.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem
