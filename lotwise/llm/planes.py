"""Token ids in shard files: blocks of ids as planes, each plane compressed.

A shard holds the ids of documents in a row. Ids are cut into blocks of a fixed
number of ids; a block is transposed into byte planes (or bit planes), so that
the seldom-changing high parts of neighbouring ids lie together, and each plane
is one zstandard frame. A footer holds the chunk index (place and sizes of each
block's planes) and the documents (id and length), so that any range of ids can
be read without the rest.

    magic | planes of block 0 | planes of block 1 | ... | footer | its length | magic

Rows with a null text have no ids but the end id. Rows with a null ``doc_id``
come first. Rows with equal ids stay separate documents, ordered by a hash of
their text, then by the text. An empty table has no shards. Other columns of the
documents are ignored.
"""

from __future__ import annotations

import functools
import json
import struct
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm import shared
from lotwise.llm.pretokens import TextEncoder, byte_letters
from lotwise.operators.tables import stored

# Fixed values of the format.
MAGIC = b"IDPLANE1"
BLOCK_IDS = 1 << 16
BYTE_PLANES = 4
BIT_PLANES = 32
LEVEL = 3

# Pieces of text whose ids a worker remembers, about 200 bytes each.
KEPT_PIECES = 800_000

MANIFEST = "shard long, path string, documents long, ids long, stored_bytes long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Byte plane p holds byte p of every id; bit plane p holds bit p, eight ids to a byte."""
    by_byte = ids.astype("<u4").view(np.uint8).reshape(-1, BYTE_PLANES).T
    if not bits:
        return [plane.tobytes() for plane in by_byte]
    by_bit = np.unpackbits(by_byte.T, axis=1, bitorder="little").T
    return [np.packbits(plane, bitorder="little").tobytes() for plane in by_bit]


def from_planes(planes: list[bytes], count: int) -> np.ndarray:
    if len(planes) == BYTE_PLANES:
        table = np.frombuffer(b"".join(planes), np.uint8).reshape(BYTE_PLANES, count)
        return np.ascontiguousarray(table.T).view("<u4").ravel()
    rows = [
        np.unpackbits(np.frombuffer(p, np.uint8), count=count, bitorder="little") for p in planes
    ]
    packed = np.packbits(np.array(rows).T, axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view("<u4").ravel()


class ShardWriter:
    """Writes documents one after another; holds one block and the footer's numbers."""

    def __init__(self, path: str, *, block_ids: int = BLOCK_IDS, bits: bool = False):
        self.path, self.block_ids, self.bits = path, block_ids, bits
        self.file = shared.create(path)
        self.file.write(MAGIC)
        self.at = len(MAGIC)
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress
        self.open_block = bytearray()
        self.index: list[list[int]] = []
        self.names: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.names.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.open_block += ids
        size = 4 * self.block_ids
        full = len(self.open_block) // size * size
        for start in range(0, full, size):
            self._write_block(bytes(self.open_block[start : start + size]))
        del self.open_block[:full]

    def _write_block(self, ids: bytes) -> None:
        frames = [self.pack(p) for p in to_planes(np.frombuffer(ids, "<u4"), self.bits)]
        self.index.append([self.at, len(ids) // 4, *map(len, frames)])
        data = b"".join(frames)
        self.file.write(data)
        self.at += len(data)

    def close(self) -> tuple[str, int, int, int]:
        if self.open_block:
            self._write_block(bytes(self.open_block))
        planes = BIT_PLANES if self.bits else BYTE_PLANES
        about = {
            "block_ids": self.block_ids,
            "planes": planes,
            "blocks": len(self.index),
            "documents": len(self.names),
        }
        head = json.dumps(about).encode()
        arrays = (
            np.array(self.index, "<u8").tobytes()
            + np.array([n or 0 for n in self.names], "<i8").tobytes()
            + np.array([n is None for n in self.names], "u1").tobytes()
            + np.array(self.lengths, "<u8").tobytes()
        )
        footer = struct.pack("<I", len(head)) + head + self.pack(arrays)
        self.file.write(footer + struct.pack("<Q", len(footer)) + MAGIC)
        self.file.close()
        total = self.at + len(footer) + 8 + len(MAGIC)
        return self.path, len(self.names), sum(self.lengths), total


class ShardReader:
    def __init__(self, path: str):
        self.file = shared.open_file(path)
        end = self.file.size() - len(MAGIC) - 8
        tail = self._at(end, 8 + len(MAGIC))
        if self._at(0, len(MAGIC)) != MAGIC or tail[8:] != MAGIC:
            raise ValueError(f"{path} is not a whole shard")
        (size,) = struct.unpack("<Q", tail[:8])
        footer = self._at(end - size, size)
        (head,) = struct.unpack_from("<I", footer)
        about = json.loads(footer[4 : 4 + head])
        arrays = zstandard.ZstdDecompressor().decompress(footer[4 + head :])
        blocks, documents = about["blocks"], about["documents"]
        width = 2 + about["planes"]
        self.block_ids = about["block_ids"]
        self.index = np.frombuffer(arrays, "<u8", blocks * width).reshape(blocks, width)
        at = self.index.nbytes
        names = np.frombuffer(arrays, "<i8", documents, at)
        unnamed = np.frombuffer(arrays, "u1", documents, at + 8 * documents)
        self.names = [None if u else n for n, u in zip(names.tolist(), unnamed.tolist())]
        self.lengths = np.frombuffer(arrays, "<u8", documents, at + 9 * documents).tolist()

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def block(self, number: int) -> bytes:
        offset, count, *sizes = self.index[number].tolist()
        data = self._at(offset, sum(sizes))
        unpack = zstandard.ZstdDecompressor().decompress
        planes, at = [], 0
        for size in sizes:
            planes.append(unpack(data[at : at + size]))
            at += size
        return from_planes(planes, count).tobytes()

    def ids(self, start: int, count: int) -> np.ndarray:
        """Any range of the shard's ids; only the blocks it touches are read."""
        first, last = start // self.block_ids, (start + count - 1) // self.block_ids
        data = b"".join(self.block(b) for b in range(first, last + 1)) if count else b""
        skip = 4 * (start - first * self.block_ids)
        return np.frombuffer(data, "<u4", count, skip) if count else np.empty(0, "<u4")

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, start within the shard, ids) in order, a block at a time."""
        held, number, start = bytearray(), 0, 0
        for name, length in zip(self.names, self.lengths):
            parts, missing = [held], 4 * length - len(held)
            while missing > 0:
                parts.append(self.block(number))
                missing -= len(parts[-1])
                number += 1
            data = b"".join(parts) if len(parts) > 1 else bytes(held)
            yield name, start, data[: 4 * length]
            held = bytearray(data[4 * length :])
            start += length


@functools.lru_cache(maxsize=2)
def library_encoder(tokenizer_path: str) -> TextEncoder:
    """Whole texts as the tokenizers library encodes them: its model takes each piece.

    Special tokens inside a text count as such, as they do by default."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    tokenizer = Tokenizer.from_file(tokenizer_path)
    pieces = tokenizer.pre_tokenizer
    if tokenizer.normalizer or not isinstance(pieces, ByteLevel) or pieces.add_prefix_space:
        raise ValueError("a byte-level tokenizer without normalizing or a leading space is needed")
    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    letter_of = {byte: letter for letter, byte in byte_letters().items()}
    tokenize = tokenizer.model.tokenize

    def encode(piece: str) -> bytes:
        letters = piece.encode("utf-8").decode("latin-1").translate(letter_of)
        return array("I", [token.id for token in tokenize(letters)]).tobytes()

    return TextEncoder(encode, special, KEPT_PIECES)


def write_shards(
    documents: DataFrame,
    tokenizer_path: str,
    *,
    end_id: int,
    folder: str | None = None,
    block_ids: int = BLOCK_IDS,
    bits: bool = False,
    make_encoder: Callable[[str], TextEncoder] = library_encoder,
) -> DataFrame:
    """Encode documents and write them as shards in ascending ``doc_id`` order.

    Returns the manifest, one row per shard. A shard is one range of the sorted
    documents; equal ``doc_id`` values may span shards, so none runs hot.
    """
    folder = folder or shared.shared_folder(documents.sparkSession, "id-planes")
    end = end_id.to_bytes(4, "little")

    def write(incoming):
        encode, writer = make_encoder(tokenizer_path), None
        number = TaskContext.get().partitionId()
        for batch in incoming:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for name, text in zip(names, texts):
                if writer is None:
                    path = shared.own_name(folder, f"shard-{number:06d}", ".ids")
                    writer = ShardWriter(path, block_ids=block_ids, bits=bits)
                writer.add(name, encode(text.as_py()) + end)
        if writer is not None:
            made = [[value] for value in (number, *writer.close())]
            names = [field.split()[0] for field in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in made], names=names)

    tie = F.xxhash64("text")
    ordered = (
        documents.select(F.col("doc_id").cast("long"), shared.whole_text().alias("text"))
        .repartitionByRange("doc_id", tie)
        .sortWithinPartitions("doc_id", tie, "text")
    )
    return stored(ordered.mapInArrow(write, MANIFEST))


def read_shards(manifest: DataFrame) -> DataFrame:
    """Documents read back from shards: ``start`` counts the ids of all documents
    before, over all shards. The driver sees one row per shard."""
    spark = manifest.sparkSession
    starts, at = [], 0
    for shard in sorted(manifest.collect(), key=lambda row: row["shard"]):
        starts.append((shard["path"], at))
        at += shard["ids"]

    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids", pa.binary()),
        ]
    )

    def read(incoming):
        for batch in incoming:
            for path, first in zip(*(column.to_pylist() for column in batch.columns)):
                rows = (
                    (name, first + start, len(ids) // 4, ids)
                    for name, start, ids in ShardReader(path).documents()
                )
                yield from shared.batches(rows, schema)

    shards = spark.createDataFrame(starts, "path string, first long")
    return shards.mapInArrow(read, DOCUMENTS)
