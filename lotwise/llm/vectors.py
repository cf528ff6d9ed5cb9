"""What the two vector searches share: usable rows, shards, blocks of queries.

Rows that repeat a whole (``vec_id``, vector) pair count once. Rows of one id with
different vectors stay separate candidates and separate queries; none of them is a
candidate of a query with their id. Rows without an id take no part, and vectors
only meet vectors of their own length.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.operators.tables import stored

QUERIES_IN_BLOCK = 1024
FOUND = "query_id long, query_hash long, vec_id long, score {score}"


def finite(vector: Column) -> Column:
    """True for vectors without missing or non-finite components."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")),
    )
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def usable_rows(table: DataFrame, keep: Column) -> DataFrame:
    """Distinct (vec_id, embedding) with the vector's length and a hash of both."""
    rows = table.filter(F.col("vec_id").isNotNull() & keep).select(
        F.col("vec_id").cast("long"), "embedding"
    )
    hashed = F.xxhash64("vec_id", "embedding")
    return rows.distinct().withColumns({"size": F.size("embedding"), "hash": hashed})


def build_shards(
    rows: DataFrame, rows_in_shard: int, build: Callable[[int, int, pd.DataFrame], str]
) -> tuple[dict[tuple[int, int], str], int]:
    """Build one index file per shard of rows; paths by (vector length, shard).

    A shard is a hash of the row, so shards are of like size whatever the data, and
    the driver holds one path for each."""
    rows = stored(rows)
    shards = max(1, math.ceil(rows.count() / rows_in_shard))

    def index(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        size, shard = (int(k) for k in key)
        path = build(size, shard, group.sort_values(["vec_id", "hash"], ignore_index=True))
        return pd.DataFrame([(size, shard, path)], columns=["size", "shard", "path"])

    numbered = rows.withColumn("shard", F.pmod("hash", F.lit(shards)))
    made = stored(
        numbered.groupBy("size", "shard").applyInPandas(
            index, "size long, shard long, path string"
        )
    )
    return {(r["size"], r["shard"]): r["path"] for r in made.collect()}, shards


def search_shards(
    queries: DataFrame,
    paths: dict[tuple[int, int], str],
    shards: int,
    k: int,
    score: str,
    open_shard: Callable[[str], object],
    find: Callable[[object, np.ndarray, int, int], list[tuple[int, float]]],
) -> DataFrame:
    """The ``k`` best of every query: (query_id, rank, vec_id, score).

    Every block of queries meets every shard once; a task has one shard open at a
    time. A query's results, ``k`` of each shard, are ranked together."""
    blocks = max(1, math.ceil(queries.count() / QUERIES_IN_BLOCK))
    met = (
        queries.withColumn("block", F.pmod("hash", F.lit(blocks)))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .repartition(shards * blocks, "shard", "block")
        .sortWithinPartitions("shard", "size")
    )

    def run(incoming: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, shard = None, None
        for batch in incoming:
            out = []
            names = ["size", "shard", "vec_id", "hash", "embedding"]
            for size, number, query, mark, vector in zip(*(batch[name] for name in names)):
                path = paths.get((size, number))
                if path is None:
                    continue
                if path != held:
                    held, shard = path, open_shard(path)
                found = find(shard, np.asarray(vector), int(query), k)
                out += [(query, mark, vec_id, value) for vec_id, value in found]
            columns = ["query_id", "query_hash", "vec_id", "score"]
            yield pd.DataFrame(out, columns=columns)

    found = met.select("size", "shard", "vec_id", "hash", "embedding").mapInPandas(
        run, FOUND.format(score=score)
    )
    place = F.expr(
        "row_number() over (partition by query_id, query_hash order by score desc, vec_id)"
    )
    ranked = found.withColumn("rank", place).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
