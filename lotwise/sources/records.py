"""Records of CSV files that hold line breaks inside quotes, cut in parallel.

A file is read in blocks, each by a task of its own, as lines. Whether a line begins
inside a quoted field follows from the number of quotes before it, so:

1. Quotes are counted for each block, and summed up over the blocks before it: one row
   for each block, whatever it holds.
2. Knowing whether it begins inside quotes, each task joins its lines into records. What
   belongs to a record that began in an earlier block, or goes on in a later one, is
   handed on as a fragment.
3. Fragments of one record are put together; they are as few as there are blocks.

Quotes inside quoted fields are doubled, which keeps their number even. A file whose
quotes are odd in number has a field that is not closed, and is refused.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = ["file", "block"]
RECORD, HEAD, TAIL = "record", "head", "tail"
QUOTE = '"'


def quoted_records(spark: SparkSession, path: str | list[str], header: list[str]) -> DataFrame:
    """(record): the text of every record but the header rows, which must all be
    ``header``. Empty lines between records are passed over."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    # One row for each block of up to spark.sql.files.maxPartitionBytes: far below a
    # millionth of the input.
    known = lines.join(F.broadcast(block_states(lines)), BLOCK, "left")
    changed = F.raise_error(F.lit("a file was cut into other blocks meanwhile: read it again"))
    known = known.select("value", *BLOCK, F.coalesce("opened", changed.cast("boolean")).alias("opened"))
    # Two light passes rather than one that is stored: few blocks have fragments.
    whole, loose = (
        known.mapInArrow(_cutter(header, part), "file string, block long, kind string, record string")
        for part in (True, False)
    )
    return whole.select("record").union(stitched(loose))


def block_states(lines: DataFrame) -> DataFrame:
    """(file, block, opened): whether each block begins inside quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    counted = lines.groupBy(*BLOCK).agg(F.sum(quotes).alias("quotes"))

    def states(file: str, blocks: list[dict]) -> Iterator[tuple]:
        total = 0
        for block, quotes in sorted((b["block"], b["quotes"]) for b in blocks):
            yield file, block, total % 2 == 1
            total += quotes
        if total % 2:
            raise ValueError(f"quotes are not closed in {file}")

    return _for_each_file(counted, ["block", "quotes"], states, "opened boolean", pa.bool_())


def _for_each_file(
    frame: DataFrame, columns: list[str], make: Callable, added: str, kind: pa.DataType
) -> DataFrame:
    """Rows (file, block, added) that ``make`` finds for the blocks of one file."""
    gathered = frame.groupBy("file").agg(F.collect_list(F.struct(*columns)).alias("blocks"))
    names = [*BLOCK, added.split()[0]]

    def run(incoming):
        for batch in incoming:
            files = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            rows = [row for file, blocks in files for row in make(file, blocks)]
            columns = zip(*rows) if rows else [()] * 3
            types = [pa.string(), pa.int64(), kind]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return gathered.mapInArrow(run, f"file string, block long, {added}")


class _Cutter:
    """Joins the lines of one block into records; what is loose at its ends are fragments."""

    def __init__(self, file: str, block: int, opened: bool, header: list[str]):
        self.place, self.header = (file, block), header
        self.inside = self.from_before = opened
        self.names_due = block == 0
        self.held: list[str] = []

    def take(self, line: str) -> tuple | None:
        self.held.append(line)
        if line.count(QUOTE) % 2:
            self.inside = not self.inside
        if self.inside:
            return None
        text, self.held = "\n".join(self.held), []
        if self.from_before:
            self.from_before = False
            return *self.place, HEAD, text
        text = text.removesuffix("\r")
        if not text:
            return None
        if self.names_due:
            self.names_due = False
            if next(csv.reader([text.removeprefix("\ufeff")])) != self.header:
                raise ValueError(f"the header of {self.place[0]} differs: {text[:200]}")
            return None
        return *self.place, RECORD, text

    def rest(self) -> list[tuple]:
        """The last line break of an unfinished record stands between two blocks."""
        if not self.held:
            return []
        if self.names_due:
            raise ValueError(f"the header of {self.place[0]} is longer than a block")
        return [(*self.place, HEAD if self.from_before else TAIL, "\n".join([*self.held, ""]))]


_SCHEMA = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("kind", pa.string()), ("record", pa.string())]
)


def _cutter(header: list[str], whole: bool):
    """Whole records of (value, file, block, opened), or else fragments."""

    def wanted(rows: list[tuple | None]) -> pa.RecordBatch:
        kept = [row for row in rows if row and (row[2] == RECORD) == whole]
        columns = zip(*kept) if kept else [()] * 4
        arrays = [pa.array(list(c), kind) for c, kind in zip(columns, _SCHEMA.types)]
        return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)

    def run(incoming):
        cutter = None
        for batch in incoming:
            rows = []
            for line, file, block, opened in zip(*(column.to_pylist() for column in batch.columns)):
                if cutter is None or cutter.place != (file, block):
                    rows += cutter.rest() if cutter else []
                    cutter = _Cutter(file, block, opened, header)
                rows.append(cutter.take(line))
            yield wanted(rows)
        if cutter:
            yield wanted(cutter.rest())

    return run


def stitched(fragments: DataFrame) -> DataFrame:
    """Records from a tail and the heads of the blocks behind it."""

    def numbers(file: str, blocks: list[dict]) -> Iterator[tuple]:
        # A block's head belongs to the last tail before it.
        last = None
        for block, kind in sorted((b["block"], b["kind"]) for b in blocks):
            if kind == HEAD:
                yield file, block, last
            else:
                last = block

    heads = _for_each_file(fragments, ["block", "kind"], numbers, "began long", pa.int64())
    tails = fragments.filter(F.col("kind") == TAIL).select("file", F.col("block").alias("began"), "block", "record")
    placed = fragments.filter(F.col("kind") == HEAD).join(heads, BLOCK).select("file", "began", "block", "record")
    joined = tails.union(placed).groupBy("file", "began").agg(
        F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda p: p["record"]), "")
    return joined.select(F.regexp_replace(text, "\r\\z", "").alias("record"))


def parsed_records(records: DataFrame, columns: list[str], options: dict[str, str]) -> DataFrame:
    """The fields of records, as text."""
    ddl = ", ".join(f"`{name.replace('`', '``')}` string" for name in columns)
    return records.select(F.from_csv("record", ddl, options).alias("r")).select("r.*")
