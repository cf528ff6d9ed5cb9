"""Bloom filters of bounded size that tasks carry as a first sieve.

They never decide a result: what one passes wrongly is only looked at too.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.url_rules import Level

BITS_PER_KEY = 10
MOST_PROBES = 7

HashPair = tuple[np.ndarray, np.ndarray]


def empty_filter(number: int, keys: int, max_bytes: int) -> Level:
    """A filter for so many keys. Beyond ``max_bytes`` it grows no more, and passes more."""
    bits = min(8 * max_bytes, max(64, -(-keys * BITS_PER_KEY // 64) * 64))
    probes = min(MOST_PROBES, max(1, round(0.69 * bits / max(1, keys))))
    return Level(number, probes, bits, np.zeros(bits // 64, np.uint64))


def filled(
    level: Level, keys: DataFrame, hashes_of: Callable[[pa.RecordBatch], list[HashPair]]
) -> Level:
    """Bits set by tasks, combined by word; the driver gets the filter's words."""
    schema = pa.schema([("word", pa.int64()), ("bits", pa.int64())])

    def run(incoming):
        for batch in incoming:
            for h1, h2 in hashes_of(batch):
                at = np.unique(np.concatenate(level.positions(h1, h2)))
                word, bit = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
                first = np.flatnonzero(np.diff(word, prepend=word[:1] + np.uint64(1)))
                columns = [word[first], np.bitwise_or.reduceat(bit, first)]
                arrays = [pa.array(c.astype(np.int64)) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    parts = keys.mapInArrow(run, "word long, bits long")
    table = parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(level.bits // 64, np.uint64)
    words[table["word"].to_numpy()] = table["bits"].to_numpy().astype(np.uint64)
    return Level(level.number, level.probes, level.bits, words)
