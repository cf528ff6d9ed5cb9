"""Fill-in-the-middle: cut texts at token boundaries and reorder the parts.

A text is cut into units: runs of A-Z and a-z, and any other sign by itself. The
places where units begin, and the end of the text, form a boundary set, kept in
containers of 65,536 offsets each: a sorted array, a bitmap or a list of runs,
whichever is smallest. The containers' cumulative cardinalities find the container
of the n-th boundary; a select inside it gives the offset.

Both cuts, and whether and how a text is reordered, come from the SHA-256 of its
``doc_id``: the same document is always cut in the same way, and rows that repeat an
id and a text have the same result. A null id counts as an empty one. A null text is
an empty one. Texts that are empty or hold one of the marks stay plain. Texts of any
length are cut whole; a table without rows gives none. Input columns that have the
name of a new one are replaced.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.llm.shared import byte_slices, whole_text

# The marks before prefix, suffix and middle, and shares of a hundred.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
REORDERED_SHARE, SPM_SHARE = 90, 20

CHUNK_BITS = 16
CHUNK = 1 << CHUNK_BITS
BITMAP_BYTES = CHUNK // 8

MADE = ["n", "form", "prefix_chars", "middle_chars", "output"]


@dataclass(frozen=True)
class ArrayContainer:
    """Offsets in order."""

    values: np.ndarray

    def __len__(self) -> int:
        return len(self.values)

    def select(self, place: int) -> int:
        return int(self.values[place])


@dataclass(frozen=True)
class RunContainer:
    """First offsets of runs, and how many offsets lie in runs up to each."""

    firsts: np.ndarray
    until: np.ndarray

    def __len__(self) -> int:
        return int(self.until[-1])

    def select(self, place: int) -> int:
        run = int(np.searchsorted(self.until, place, "right"))
        before = int(self.until[run - 1]) if run else 0
        return int(self.firsts[run]) + place - before


@dataclass(frozen=True)
class BitmapContainer:
    """One bit an offset, and how many are set in words up to each."""

    words: np.ndarray
    until: np.ndarray

    def __len__(self) -> int:
        return int(self.until[-1])

    def select(self, place: int) -> int:
        word = int(np.searchsorted(self.until, place, "right"))
        left = place - (int(self.until[word - 1]) if word else 0)
        bits = int(self.words[word])
        for _ in range(left):
            bits &= bits - 1
        return word * 64 + (bits & -bits).bit_length() - 1


def container_of(inside: np.ndarray):
    """The smallest container for the set offsets of a mask with at least one."""
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    firsts, ends = edges[::2], edges[1::2]
    lengths = ends - firsts
    size = int(lengths.sum())
    if 4 * len(firsts) < min(2 * size, BITMAP_BYTES):
        return RunContainer(firsts.astype(np.uint16), np.cumsum(lengths))
    if 2 * size <= BITMAP_BYTES:
        return ArrayContainer(np.flatnonzero(inside).astype(np.uint16))
    whole = np.zeros(CHUNK, bool)
    whole[: len(inside)] = inside
    words = np.packbits(whole, bitorder="little").view("<u8")
    return BitmapContainer(words, np.cumsum(np.bitwise_count(words), dtype=np.int64))


@dataclass
class BoundarySet:
    """Containers by the high bits of their offsets, with cumulative cardinalities."""

    keys: list[int] = field(default_factory=list)
    containers: list = field(default_factory=list)
    until: list[int] = field(default_factory=list)

    @classmethod
    def of_mask(cls, inside: np.ndarray) -> BoundarySet:
        made = cls()
        for key, at in enumerate(range(0, len(inside), CHUNK)):
            part = inside[at : at + CHUNK]
            if part.any():
                made.keys.append(key)
                made.containers.append(container_of(part))
                made.until.append(len(made) + len(made.containers[-1]))
        return made

    def __len__(self) -> int:
        return self.until[-1] if self.until else 0

    def select(self, place: int) -> int:
        """The offset that has ``place`` boundaries before it."""
        if not 0 <= place < len(self):
            raise IndexError(place)
        at = int(np.searchsorted(self.until, place, "right"))
        before = self.until[at - 1] if at else 0
        return (self.keys[at] << CHUNK_BITS) + self.containers[at].select(place - before)


def boundaries(text: str) -> BoundarySet:
    """Where units begin, and the end of the text: one more than there are units."""
    signs = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = (signs | 32) - ord("a") < 26
    inside = np.ones(len(signs) + 1, bool)
    inside[1:-1] = ~(letter[1:] & letter[:-1])
    return BoundarySet.of_mask(inside)


def draws(doc_id: str) -> list[int]:
    digest = hashlib.sha256(f"1:{doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4]) for i in range(0, 16, 4)]


def rearranged(text: str, doc_id: str) -> tuple:
    """Number of units, form, lengths of prefix and middle, and the output."""
    found = boundaries(text)
    units = len(found) - 1
    first, second, whether, how = draws(doc_id)
    marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or whether % 100 >= REORDERED_SHARE:
        return units, PLAIN, None, None, text
    a, b = (found.select(place) for place in sorted((first % (units + 1), second % (units + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if how % 100 < SPM_SHARE:
        form, output = SPM, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = PSM, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return units, form, a, b - a, output


def fill_in_middle(documents: DataFrame, *, text: str = "text") -> DataFrame:
    """Replace a document's text by its number of units ``n``, ``form``, ``prefix_chars``,
    ``middle_chars`` (null if plain) and ``output``."""
    kept = [c for c in documents.columns if c.lower() not in {*MADE, text.lower()}]
    frame = documents.select(
        *kept, F.coalesce(F.col("doc_id").cast("string"), F.lit("")), whole_text(text)
    )
    made = [T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType()]
    schema = T.StructType(
        [*frame.schema.fields[:-2], *(T.StructField(n, t) for n, t in zip(MADE, made))]
    )
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(incoming):
        for whole in incoming:
            for batch in byte_slices(whole):
                ids, texts = (batch.column(batch.num_columns - i).to_pylist() for i in (2, 1))
                rows = [rearranged(t, i) for i, t in zip(ids, texts)]
                columns = [pa.array(v, k) for v, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns], names=[*kept, *MADE])

    return frame.mapInArrow(run, schema)


def restored(form: str = "form", output: str = "output") -> Column:
    """The text again, from an output and its form alone. A reordered text holds each
    mark once: it had none before, and no two marks can overlap."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(F.col(form) == PSM, F.concat(parts[1], parts[3], parts[2]))
        .when(F.col(form) == SPM, F.concat(parts[2], parts[3], parts[1]))
        .otherwise(F.col(output))
    )
