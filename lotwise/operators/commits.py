"""Commits: which files of a table count, as numbered entries beside them.

Data is written first, into a folder nobody reads; an entry then names it, in one step.
Readers follow the entries, so what a failed or repeated write leaves behind is never
read, and a reader that has begun keeps the files it has listed. Entries are few: one
for each write, and compaction folds them into one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Entries live here, below the table.
LOG = "_commits"


class Commits:
    """The entries of one table, on any file system Spark can reach."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.settings = spark.sparkContext._jsc.hadoopConfiguration()
        self.folder = self._path(f"{self.table}/{LOG}")
        self.files = self.folder.getFileSystem(self.settings)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def numbers(self) -> list[int]:
        if not self.files.exists(self.folder):
            return []
        names = (status.getPath().getName() for status in self.files.listStatus(self.folder))
        return sorted(int(name[:-5]) for name in names if name.endswith(".json"))

    def _entry(self, number: int):
        return self._path(f"{self.folder.toString()}/{number:012d}.json")

    def read(self) -> list[dict]:
        """All entries in order. One that compaction folds away meanwhile is in the fold."""
        found = []
        for number in self.numbers():
            stream = self.files.open(self._entry(number))
            try:
                text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            found.append(json.loads(text) | {"number": number})
        return found

    def add(self, entry: dict, attempts: int = 20) -> int:
        """Add an entry under the next free number; of two writers one takes the next."""
        draft = self._path(f"{self.folder.toString()}/.{uuid.uuid4().hex}")
        stream = self.files.create(draft, True)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        options = self.spark.sparkContext._gateway.new_array(
            self.jvm.org.apache.hadoop.fs.Options.Rename, 0
        )
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.files.getUri(), self.settings
        )
        draft = self.files.makeQualified(draft)
        for _ in range(attempts):
            number = max(self.numbers(), default=0) + 1
            place = self.files.makeQualified(self._entry(number))
            try:
                context.rename(draft, place, options)
                return number
            except Exception:
                if not self.files.exists(place):
                    raise
        raise RuntimeError(f"no number was free for a commit to {self.table}")

    def remove(self, numbers: list[int]) -> None:
        for number in numbers:
            self.files.delete(self._entry(number), False)

    def new_folder(self) -> str:
        return f"data-{uuid.uuid4().hex}"

    def folders(self) -> list[str]:
        """Folders of data there are, committed or not."""
        root = self._path(self.table)
        if not self.files.exists(root):
            return []
        names = (status.getPath().getName() for status in self.files.listStatus(root))
        return [name for name in names if name.startswith("data-")]

    def size(self, folder: str) -> int:
        path = self._path(f"{self.table}/{folder}")
        return self.files.getContentSummary(path).getLength()

    def delete(self, folder: str) -> None:
        self.files.delete(self._path(f"{self.table}/{folder}"), True)


# Versions: each write replaces the table.


def publish(frame: DataFrame, target: str, format: str = "parquet", **options: str) -> int:
    """Write a new version of a table and make it the current one.

    Readers see the version before until all of this one is written; a write that fails
    half way changes nothing for them. Old versions stay until they are removed."""
    commits = Commits(frame.sparkSession, target)
    folder = commits.new_folder()
    frame.write.format(format).options(**options).save(f"{commits.table}/{folder}")
    return commits.add({"folder": folder, "format": format, "schema": frame.schema.json()})


def read_published(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The current version of a table, or an earlier one that has not been removed."""

    entries = [e for e in Commits(spark, target).read() if version in (None, e["number"])]
    if not entries:
        raise FileNotFoundError(f"nothing has been published at {target}")
    entry = entries[-1]
    schema = StructType.fromJson(json.loads(entry["schema"]))
    return spark.read.schema(schema).format(entry["format"]).load(f"{target.rstrip('/')}/{entry['folder']}")


def remove_old_versions(spark: SparkSession, target: str, keep: int = 1) -> list[str]:
    """Remove all but the newest versions, and folders of writes that failed. Run it when
    no reader of an old version and no writer is at work."""
    commits = Commits(spark, target)
    entries = commits.read()
    kept = {e["folder"] for e in entries[-max(1, keep) :]}
    commits.remove([e["number"] for e in entries[: -max(1, keep)]])
    gone = [folder for folder in commits.folders() if folder not in kept]
    for folder in gone:
        commits.delete(folder)
    return gone


# Appends: each write adds a folder, once for each batch of a run.


def append_once(
    frame: DataFrame, table: str, run: str, batch: int, format: str = "parquet", **options: str
) -> bool:
    """Append a batch of a run, unless it has been appended. What an attempt that failed
    before its entry has written is never read."""
    commits = Commits(frame.sparkSession, table)
    if any(_holds(entry, run, batch) for entry in commits.read()):
        return False
    folder = commits.new_folder()
    frame.write.format(format).options(**options).save(f"{commits.table}/{folder}")
    entry = {"folder": folder, "run": run, "batch": batch, "schema": frame.schema.json()}
    commits.add(entry | {"format": format})
    return True


def _holds(entry: dict, run: str, batch: int) -> bool:
    """Batches of a run come in order, so a fold only names the last one of each."""
    if "through" in entry:
        return entry["through"].get(run, -1) >= batch
    return entry["run"] == run and entry["batch"] == batch


def _live(entries: list[dict]) -> list[dict]:
    replaced = {folder for e in entries for folder in e.get("replaces", [])}
    return [e for e in entries if e["folder"] not in replaced]


def read_appended(spark: SparkSession, table: str) -> DataFrame:
    """The rows of all appended batches, each once."""

    entries = _live(Commits(spark, table).read())
    if not entries:
        raise FileNotFoundError(f"nothing has been appended to {table}")
    schema = StructType.fromJson(json.loads(entries[-1]["schema"]))
    folders = [f"{table.rstrip('/')}/{e['folder']}" for e in entries]
    return spark.read.schema(schema).format(entries[-1]["format"]).load(folders)


TARGET_BYTES = 128 << 20


def compact(spark: SparkSession, table: str, target_bytes: int = TARGET_BYTES) -> int:
    """Write the rows of small folders into files of about ``target_bytes``; returns how
    many folders were replaced.

    Folders are packed by size, first fit, into bins that become one file each. The new
    folder and what it replaces are one entry, so readers find the rows in the old
    folders or in the new one, never in both. Old folders stay for readers at work, until
    :func:`remove_unread`. One compaction runs at a time; appends may go on beside it."""
    commits = Commits(spark, table)
    entries = commits.read()
    live = [e for e in _live(entries)]
    sizes = {e["folder"]: commits.size(e["folder"]) for e in live}
    small = [e for e in live if sizes[e["folder"]] < target_bytes // 2]
    if len(small) < 2:
        return 0
    bins: list[list] = []
    for entry in sorted(small, key=lambda e: -sizes[e["folder"]]):
        size = sizes[entry["folder"]]
        place = next((b for b in bins if b[0] + size <= target_bytes), None)
        if place is None:
            bins.append(place := [0, []])
        place[0] += size
        place[1].append(entry["folder"])

    newest = entries[-1]
    schema = StructType.fromJson(json.loads(newest["schema"]))
    folder = commits.new_folder()
    for _, names in bins:
        paths = [f"{commits.table}/{name}" for name in names]
        part = spark.read.schema(schema).format(newest["format"]).load(paths).coalesce(1)
        part.write.format(newest["format"]).mode("append").save(f"{commits.table}/{folder}")
    through: dict[str, int] = {}
    for e in entries:
        for run, batch in (e["through"] if "through" in e else {e["run"]: e["batch"]}).items():
            through[run] = max(batch, through.get(run, -1))
    fold = {"folder": folder, "replaces": [e["folder"] for e in small], "through": through}
    commits.add(fold | {"schema": newest["schema"], "format": newest["format"]})
    return len(small)


def remove_unread(spark: SparkSession, table: str) -> list[str]:
    """Remove folders that were replaced or never entered, and entries that a fold has
    taken in. Run it when no reader of an old listing and no writer is at work."""
    commits = Commits(spark, table)
    entries = commits.read()
    live = {e["folder"] for e in _live(entries)}
    commits.remove([e["number"] for e in entries if e["folder"] not in live])
    gone = [folder for folder in commits.folders() if folder not in live]
    for folder in gone:
        commits.delete(folder)
    return gone
