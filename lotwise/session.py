"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str, **overrides: str) -> SparkSession:
    """A session with the recommended settings; submit-time settings for memory,
    executors and shuffle partitions are left to the cluster."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def working_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Where it is unset, a local master, whose tasks share the driver's disk, keeps
    them below its warehouse folder; a cluster has to name a folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir', 'spark-warehouse')}/lotwise-work"
    return root.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path nobody has used yet, below the shared working folder."""
    return f"{working_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the caller's own, on any file system; absent is fine."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(folder, True)
