"""Byte-level BPE encoding and decoding.

A short word holds its part boundaries and, beside each, the rank of the merge
that would remove it, in two contiguous arrays. The least rank is found by
scanning, its boundary is deleted, and the two ranks next to it are refreshed.
Words beyond ``SHORT_WORD`` bytes, for which scanning again and again would take
quadratic time, take their merges from a heap in the same order.

Null texts are empty and have no ids. Rows are kept one to one, repeated or not,
with all their columns.
"""

from __future__ import annotations

import functools
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lotwise.llm import shared
from lotwise.llm.pretokens import KEPT_PIECES, TextEncoder, byte_letters

SHORT_WORD = 96
NO_MERGE = 1 << 40


class Vocabulary:
    """Merges and tokens of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        if model["type"] != "BPE" or content["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary is needed")
        letters = byte_letters()
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = ids[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(merges)}
        self.merged = [ids[a + b] for a, b in merges]
        self.tokens: list[bytes] = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.tokens[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.tokens[i] = token.encode()

    def merge_word(self, word: bytes) -> list[int]:
        if len(word) > SHORT_WORD:
            return self._merge_long(word)
        rank_of = self.ranks.get
        # parts[i] starts at boundary i; ranks[i] belongs to the boundary behind it.
        parts = [self.byte_ids[b] for b in word]
        ranks = [rank_of(pair, NO_MERGE) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_MERGE:
                break
            i = ranks.index(least)
            parts[i] = self.merged[least]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of((parts[i], parts[i + 1]), NO_MERGE)
            if i:
                ranks[i - 1] = rank_of((parts[i - 1], parts[i]), NO_MERGE)
        return parts

    def _merge_long(self, word: bytes) -> list[int]:
        parts: list[int] = [self.byte_ids[b] for b in word]
        after = [*range(1, len(parts)), -1]
        before = [-1, *range(len(parts) - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            rank = self.ranks.get((parts[i], parts[j])) if j >= 0 else None
            if rank is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[j]))

        for i in range(len(parts)):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j < 0 or parts[i] != left or parts[j] != right:
                continue
            parts[i], parts[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [part for part in parts if part >= 0]

    def decode(self, ids: bytes) -> str:
        token = self.tokens.__getitem__
        data = b"".join(map(token, np.frombuffer(ids, "<u4").tolist()))
        return data.decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@functools.lru_cache(maxsize=2)
def encoder(path: str, room: int) -> TextEncoder:
    words = vocabulary(path)

    def encode(piece: str) -> bytes:
        return np.array(words.merge_word(piece.encode("utf-8")), "<u4").tobytes()

    return TextEncoder(encode, words.special, room)


def encode_documents(
    documents: DataFrame,
    vocabulary_path: str,
    *,
    text: str = "text",
    into: str = "token_ids",
    decoded_into: str | None = None,
    room: int = KEPT_PIECES,
) -> DataFrame:
    """Add the ids of each text, as little-endian unsigned 32-bit integers; under
    ``decoded_into``, if named, also the text decoded from them. Each task remembers
    ``room`` pieces. Input columns of the new names are replaced.

    Special tokens inside a text count as such; none is added."""

    def make():
        encode, decode = encoder(vocabulary_path, room), vocabulary(vocabulary_path).decode
        if decoded_into is None:
            return lambda value: (encode(value or ""),)

        def both(value):
            ids = encode(value or "")
            return ids, decode(ids)

        return both

    new = {into: T.BinaryType()}
    if decoded_into is not None:
        new[decoded_into] = T.StringType()
    return _with_columns(documents, new, text, make)


def decode_documents(
    documents: DataFrame, vocabulary_path: str, *, ids: str = "token_ids", into: str = "decoded"
) -> DataFrame:
    """Add the text of each row's ids; special tokens are spelt out, and bytes that
    are no UTF-8 become replacement characters."""

    def make():
        decode = vocabulary(vocabulary_path).decode
        return lambda value: (decode(value or b""),)

    return _with_columns(documents, {into: T.StringType()}, ids, make)


ARROW = {T.BinaryType(): pa.binary(), T.StringType(): pa.string()}


def _with_columns(frame, new, source, make):
    """Add columns (name: type) computed from one column, in pieces of bounded size."""
    taken = {name.lower() for name in new}
    kept = [name for name in frame.columns if name.lower() not in taken]
    place = kept.index(source)

    def run(incoming):
        convert = make()
        for batch in incoming:
            for piece in _slices(batch):
                columns = zip(*(convert(value.as_py()) for value in piece.column(place)))
                made = [pa.array(list(c), ARROW[kind]) for c, kind in zip(columns, new.values())]
                arrays = [*piece.columns, *made]
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *new])

    fields = [T.StructField(name, kind) for name, kind in new.items()]
    schema = T.StructType([*frame.select(*kept).schema.fields, *fields])
    return frame.select(*kept).mapInArrow(run, schema)


def _slices(batch: pa.RecordBatch):
    """Pieces of a batch of which each has few rows or little text."""
    rows = max(1, min(512, batch.num_rows * shared.BATCH_BYTES // (1 + batch.nbytes)))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
