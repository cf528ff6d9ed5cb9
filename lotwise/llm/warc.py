"""Web archives compressed with a shared dictionary, one zstandard frame per record.

An archive starts with a skippable frame that holds the dictionary; each WARC
record follows as one frame of its own. The reader loads the dictionary, decodes
frame by frame and checks version, header fields, lengths and payload digest.

Of pages with equal payloads of ``min_bytes`` or more, the one with the largest
``page_id`` is stored whole; the others are ``revisit`` records that name it.
A null html is an empty payload, a null url leaves the target out. A null
``page_id`` is written as ``none`` and read back as null; it is the stored one
only where no copy has an id. Rows that repeat a whole page, id included, are all
stored whole. Other columns are ignored; an empty table makes no archive.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm import shared
from lotwise.operators.tables import stored

# Fixed values of the format.
SKIPPABLE = 0x184D2A5D
ANY_SKIPPABLE = range(0x184D2A50, 0x184D2A60)
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN = "2024-01-01T00:00:00Z"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")

# The dictionary is trained on at most this many pages, this much of each.
SAMPLE_PAGES = 200
SAMPLE_CHARS = 16_384
DICTIONARY_BYTES = 65_536

# An archive is closed once it holds this many bytes.
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 1 << 20
LEVEL = 3

MANIFEST = "path string, records long, stored_bytes long"
RECORDS = (
    "page_id long, url string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, payload binary"
)
RECORD_FIELDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded, repeatable sample of pages; empty if they are too few."""
    start = F.substring(F.coalesce("html", F.lit("")), 1, SAMPLE_CHARS)
    mark = F.xxhash64("page_id", "url")
    least = pages.select(mark.alias("h")).orderBy("h").limit(SAMPLE_PAGES)
    cut = least.agg(F.max("h")).first()[0]
    rows = pages.filter(mark <= F.lit(cut)).select(start.alias("html")).limit(SAMPLE_PAGES).collect()
    texts = [row["html"].encode("utf-8", "surrogatepass") for row in rows if row["html"]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b""


def _id_uri(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _id_of(uri: str) -> int | None:
    name = uri.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def record_bytes(page_id, url, payload: bytes, digest: str, revisits: int | None, revisit: bool):
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    )
    block = http.encode() + (b"" if revisit else payload)
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _id_uri(page_id),
        "WARC-Date": WRITTEN,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    if url is not None:
        fields["WARC-Target-URI"] = url.replace("\r", "%0D").replace("\n", "%0A")
    if revisit:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _id_uri(revisits)}
    fields["Content-Length"] = str(len(block))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


class ArchiveWriter:
    def __init__(self, path: str, dictionary: bytes):
        self.path, self.records, self.size = path, 0, 0
        self.file = shared.create(path)
        self._write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        self.pack = packer.compress

    def _write(self, data: bytes) -> None:
        self.file.write(data)
        self.size += len(data)

    def add(self, record: bytes) -> None:
        self._write(self.pack(record))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.file.close()
        return self.path, self.records, self.size


def write_archives(
    pages: DataFrame, *, folder: str | None = None, min_bytes: int = 1000
) -> DataFrame:
    """Write pages as archives and return the manifest, one row per archive.

    Copies are found by digest. The groups are aggregated before they are
    shuffled; pages without possible copies get keys of their own, so that the
    join spreads, and a group of very many copies is cut by the skew join.
    """
    dictionary = train_dictionary(pages)
    folder = folder or shared.shared_folder(pages.sparkSession, "warc")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "digest", F.sha1("payload")
    )
    large = F.length("payload") >= min_bytes
    groups = (
        rows.filter(large)
        .groupBy(F.col("digest").alias("key"))
        .agg(F.max("page_id").alias("whole"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url", "digest").cast("string"))
    planned = (
        rows.withColumn("key", F.when(large, F.col("digest")).otherwise(alone))
        .join(groups, "key", "left")
        .select(
            F.col("page_id").cast("long"),
            "url",
            "payload",
            "digest",
            "whole",
            (F.col("copies").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("whole"))).alias(
                "revisit"
            ),
        )
    )

    def write(incoming):
        writer, number, done = None, TaskContext.get().partitionId(), []
        for batch in incoming:
            for row in zip(*batch.columns):
                page_id, url, content, digest, whole, revisit = (value.as_py() for value in row)
                if writer is None:
                    path = shared.own_name(folder, f"pages-{number:06d}", ".warc.zst")
                    writer = ArchiveWriter(path, dictionary)
                writer.add(record_bytes(page_id, url, content, digest, whole, revisit))
                if writer.size >= ARCHIVE_BYTES:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        if done:
            names = [field.split()[0] for field in MANIFEST.split(", ")]
            columns = [pa.array(list(column)) for column in zip(*done)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return stored(planned.mapInArrow(write, MANIFEST))


def frames(path: str) -> Iterator[bytes]:
    """The content of each frame after the leading dictionary frame."""
    with shared.open_stream(path) as file:
        head = file.read(8)
        if len(head) < 8:
            raise ValueError(f"{path} has no dictionary frame")
        magic, size = struct.unpack("<II", head)
        if magic not in ANY_SKIPPABLE:
            raise ValueError(f"{path} does not start with a dictionary frame")
        dictionary = file.read(size)
        if len(dictionary) != size:
            raise ValueError(f"{path}: the dictionary is cut off")
        if dictionary.startswith(ZSTD_FRAME):
            dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        unpacker = zstandard.ZstdDecompressor(dict_data=known)
        data = file.read(READ_BYTES)
        while data:
            frame, parts = unpacker.decompressobj(), []
            while True:
                parts.append(frame.decompress(data))
                if frame.eof:
                    data = frame.unused_data or file.read(READ_BYTES)
                    break
                data = file.read(READ_BYTES)
                if not data:
                    raise ValueError(f"{path}: the last frame is cut off")
            yield b"".join(parts)


def parse_record(record: bytes) -> tuple:
    """The row of one record; anything that does not hold together raises."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not gap or version not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header line without a name: {line[:60]!r}")
        fields[name.strip().lower()] = value.strip()
    missing = [name for name in REQUIRED if name.lower() not in fields]
    if missing:
        raise ValueError(f"record without {', '.join(missing)}")
    length = int(fields["content-length"])
    if length < 0 or len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"{fields['warc-record-id']}: the block is not {length} bytes long")
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    sizes = [h for h in http.decode("latin-1").split("\r\n") if h.startswith("Content-Length:")]
    if not gap or not http.startswith(b"HTTP/") or len(sizes) != 1:
        raise ValueError(f"{fields['warc-record-id']}: not a response")
    size = int(sizes[0].partition(":")[2])
    kind = fields["warc-type"]
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    refers = None
    if kind == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"{fields['warc-record-id']}: the payload is not the one announced")
    elif kind == "revisit":
        if payload:
            raise ValueError(f"{fields['warc-record-id']}: a revisit with a payload")
        refers, payload = _id_of(fields["warc-refers-to"]), None
    else:
        raise ValueError(f"record type {kind!r}")
    page_id, url = _id_of(fields["warc-record-id"]), fields.get("warc-target-uri")
    return page_id, url, kind, size, digest, refers, payload


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of the archives that a manifest names."""

    def read(incoming):
        for batch in incoming:
            for path in batch.column(0).to_pylist():
                yield from shared.batches(map(parse_record, frames(path)), RECORD_FIELDS)

    paths = manifest.select("path")
    spread = paths.repartition(max(1, manifest.count()), F.xxhash64("path"))
    return spread.mapInArrow(read, RECORDS)
