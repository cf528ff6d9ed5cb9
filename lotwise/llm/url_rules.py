"""URL rules held in a cascade of Bloom filters.

The keys of a URL are its host and the host's parent domains, each with every
prefix of the path that has the length of some rule's path. Over the corpus's
complete set of such keys, the first filter of a cascade encodes the listed keys,
the second the unlisted ones that the first lets through, the third the listed
ones that the second lets through, and so on until none is left. The first level
that denies a key then tells exactly whether it is listed, so judging needs no
join: one cascade holds the blocking keys, one the allowing ones.

The longest listed key decides, of equally long ones that with the longer host.
A URL without a listed key is allowed. A url that is null or has no ``://`` has an
empty host and path and no key. A key listed both ways blocks. Rules without a
host or with another verdict than allow or block are ignored, as are those whose
path is neither empty nor begins with a slash. Rows are kept one to one with all
columns, but host, path, rule and verdict are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.shared import free_name
from lotwise.operators.tables import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK, ALLOW = "block", "allow"

# A filter that would be larger is not broadcast; rules are then joined.
MAX_FILTER_BYTES = 64 << 20
LATER_RATE = 0.5
LEAST_BITS = 256
MAX_LEVELS = 64


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(_after(url), "#", 1)).otherwise("")
    rest = F.substring_index(F.coalesce(rest, F.lit("")), "?", 1)
    host = F.substring_index(rest, "/", 1)
    path = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.translate(host, UPPER, LOWER), path


def _after(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def usable(rules: DataFrame) -> DataFrame:
    """Rules as (key, blocks, path_length), one per key."""
    path = F.coalesce("path", F.lit(""))
    kept = rules.filter(
        (F.col("host") != "") & F.col("verdict").isin(BLOCK, ALLOW)
    ).filter((path == "") | path.startswith("/"))
    key = F.concat(F.translate("host", UPPER, LOWER), path).alias("key")
    listed = kept.select(key, (F.col("verdict") == BLOCK).alias("blocks"), F.length(path).alias("n"))
    return listed.groupBy("key").agg(
        F.max("blocks").alias("blocks"), F.first("n").alias("path_length")
    )


def with_keys(pages: DataFrame, lengths: list[int], into: str) -> DataFrame:
    """Add host, path and, under the name ``into``, all keys of the URL, longest first."""
    host, path = host_and_path(F.col("url").cast("string"))
    kept = pages.withColumns({"host": host, "path": path})
    labels = F.split("host", "\\.")
    names = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    known = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    fitting = F.filter(known, lambda n: n <= F.length("path"))
    pairs = F.flatten(
        F.transform(
            F.filter(names, lambda name: name != ""),
            lambda name: F.transform(
                fitting,
                lambda n: F.struct(
                    (-F.length(name) - n).alias("order"),
                    n.alias("path_length"),
                    F.concat(name, F.substring(F.col("path"), F.lit(1), n)).alias("key"),
                ),
            ),
        )
    )
    return kept.withColumn(into, F.transform(F.array_sort(pairs), lambda p: p["key"]))


def hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2")]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its number in the cascade, hash count, size and bits."""

    number: int
    probes: int
    bits: int
    words: np.ndarray | None = None

    def positions(self, h1: np.ndarray, h2: np.ndarray) -> list[np.ndarray]:
        a, b = h1.astype(np.uint64), h2.astype(np.uint64)
        start = np.uint64(1 + 1000 * self.number)
        return [
            _mixed(a + b * (start + np.uint64(i))) % np.uint64(self.bits)
            for i in range(self.probes)
        ]

    def passes(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        inside = np.ones(len(h1), bool)
        for at in self.positions(h1, h2):
            word = self.words[(at >> np.uint64(6)).astype(np.int64)]
            inside &= (word >> (at & np.uint64(63))) & np.uint64(1) == 1
        return inside


def listed_in(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Exact for every key the cascade was built over."""
    answer = np.full(len(h1), len(levels) % 2 == 1)
    undecided = np.arange(len(h1))
    for number, level in enumerate(levels):
        inside = level.passes(h1[undecided], h2[undecided])
        answer[undecided[~inside]] = number % 2 == 1
        undecided = undecided[inside]
    return answer


def _sized(number: int, inside: int, rate: float) -> Level:
    bits = math.ceil(-inside * math.log(rate) / math.log(2) ** 2)
    bits = max(LEAST_BITS, -(-bits // 64) * 64)
    return Level(number, max(1, round(-math.log2(rate))), bits)


def _filled(level: Level, keys: DataFrame) -> Level:
    """Bits set by tasks over their keys, combined by word; the driver gets the words."""

    def words(incoming):
        for batch in incoming:
            h1, h2 = batch["h1"].to_numpy(), batch["h2"].to_numpy()
            at = np.unique(np.concatenate(level.positions(h1, h2)))
            word, bit = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
            first = np.flatnonzero(np.diff(word, prepend=word[:1] + np.uint64(1)))
            joined = np.bitwise_or.reduceat(bit, first) if len(at) else bit
            yield pd.DataFrame(
                {"word": word[first].astype(np.int64), "bits": joined.astype(np.int64)}
            )

    parts = keys.select("h1", "h2").mapInPandas(words, "word long, bits long")
    rows = parts.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    full = np.zeros(level.bits // 64, np.uint64)
    full[rows["word"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint64)
    return Level(level.number, level.probes, level.bits, full)


def _passing(level: Level, keys: DataFrame) -> DataFrame:
    def keep(incoming):
        for batch in incoming:
            yield batch[level.passes(batch["h1"].to_numpy(), batch["h2"].to_numpy())]

    return keys.mapInPandas(keep, keys.schema)


def build_cascade(
    listed: DataFrame, universe: DataFrame, *, max_bytes: int = MAX_FILTER_BYTES
) -> list[Level] | None:
    """Levels over two tables of distinct keys with their hashes (key, h1, h2).

    None if the first filter, the largest, would exceed ``max_bytes``."""
    inside, everything = listed.count(), universe.count()
    if not inside:
        return []
    rate = min(LATER_RATE, math.sqrt(0.5) * inside / max(1, everything))
    level = _sized(0, inside, rate)
    if level.bits // 8 > max_bytes:
        return None
    levels = [_filled(level, listed)]
    wrong = stored(_passing(levels[0], universe).join(listed.select("key"), "key", "left_anti"))
    encoded, other = listed, wrong
    while (count := other.count()) > 0:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("two keys share both 64-bit hashes")
        levels.append(_filled(_sized(len(levels), count, LATER_RATE), other))
        encoded, other = other, stored(_passing(levels[-1], encoded))
    return levels


def judge(
    pages: DataFrame, rules: DataFrame, *, max_bytes: int = MAX_FILTER_BYTES
) -> DataFrame:
    """Add host, path, ``rule`` (the deciding key or null) and ``verdict``."""
    spark = pages.sparkSession
    listed = stored(usable(rules).select("key", "blocks", "path_length", *hashes(F.col("key"))))
    lengths = sorted(r[0] for r in listed.select("path_length").distinct().collect())
    pages = pages.drop("host", "path", "rule", "verdict")
    keys = free_name(pages, "keys")
    keyed = with_keys(pages, lengths, keys)
    universe = stored(
        keyed.select(F.explode(keys).alias("key")).distinct().select("key", *hashes(F.col("key")))
    )
    blocking = build_cascade(listed.filter("blocks"), universe, max_bytes=max_bytes)
    allowing = build_cascade(listed.filter("not blocks"), universe, max_bytes=max_bytes)
    if blocking is None or allowing is None:
        return _joined(keyed, listed, keys)
    held = spark.sparkContext.broadcast((blocking, allowing))

    @F.pandas_udf("place int, blocks boolean")
    def first_listed(h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
        sizes = h1.map(len).to_numpy()
        rows = np.repeat(np.arange(len(h1)), sizes)
        flat1 = np.concatenate([*h1, np.empty(0, np.int64)]).astype(np.int64)
        flat2 = np.concatenate([*h2, np.empty(0, np.int64)]).astype(np.int64)
        bad, good = (listed_in(levels, flat1, flat2) for levels in held.value)
        hits = np.flatnonzero(bad | good)
        first, where = np.unique(rows[hits], return_index=True)
        place, blocks = np.full(len(h1), -1), np.zeros(len(h1), bool)
        starts = np.cumsum(sizes) - sizes
        place[first] = hits[where] - starts[first]
        blocks[first] = bad[hits[where]]
        return pd.DataFrame({"place": place, "blocks": blocks})

    h1 = F.transform(keys, lambda k: F.xxhash64(k))
    h2 = F.transform(keys, lambda k: F.xxhash64(k, F.lit(1)))
    found = free_name(keyed, "found")
    decided = keyed.withColumn(found, first_listed(h1, h2))
    rule = F.try_element_at(keys, F.col(f"{found}.place") + 1)
    return decided.withColumns(
        {
            "rule": F.when(F.col(f"{found}.place") >= 0, rule),
            "verdict": F.when(F.col(f"{found}.blocks"), BLOCK).otherwise(ALLOW),
        }
    ).drop(found, keys)


def _joined(keyed: DataFrame, listed: DataFrame, keys: str) -> DataFrame:
    """The same by a join, for more rules than a broadcast filter may hold."""
    row, found = free_name(keyed, "row"), free_name(keyed, "found")
    numbered = stored(keyed.withColumn(row, F.monotonically_increasing_id()))
    exploded = numbered.select(row, F.posexplode(keys).alias("place", "key"))
    best = F.min(F.struct("place", "key", "blocks")).alias(found)
    decided = exploded.join(listed.select("key", "blocks"), "key").groupBy(row).agg(best)
    return (
        numbered.join(decided, row, "left")
        .withColumns(
            {
                "rule": F.col(f"{found}.key"),
                "verdict": F.when(F.col(f"{found}.blocks"), BLOCK).otherwise(ALLOW),
            }
        )
        .drop(row, found, keys)
    )
