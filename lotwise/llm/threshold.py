"""Exact top-k by inner product with the threshold algorithm.

Each shard keeps, for every dimension, its rows sorted by value. A query goes down
the lists of all its dimensions together, from the large end where its component
is positive and from the small end where it is negative, and scores each row when
it first comes up. No row still unseen can score above the sum of the products at
the lists' current places; once that bound is below the k-th score, the rest cannot
matter. A bound equal to it goes on, since a smaller ``vec_id`` would win the tie.
The search also ends when every row has come up in some list.

Components are floor(``scale`` * x). Vectors that are null, empty or hold null or
non-finite components take no part; zero vectors do. See ``vectors`` for repeated
rows and lengths. Scores are exact. Scaled components of 2^53 or more, and results
that a long cannot hold, are refused with an error rather than returned wrong.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm import shared
from lotwise.llm.vectors import build_shards, finite, search_shards, usable_rows

ROWS_IN_SHARD = 8192
SCALE = 256
# Rows taken from each list at first; then twice as many each time.
FIRST_DEPTH = 16
EXACT_DOUBLES = 1 << 53


class SortedLists:
    def __init__(self, ids: np.ndarray, table: np.ndarray, order: np.ndarray):
        """``table`` holds whole numbers as doubles; ``order[d]`` numbers its rows by
        ascending value in dimension d."""
        self.ids, self.table = ids, table
        self.order = order.astype(np.intp)
        self.sorted = np.take_along_axis(table.T, self.order, axis=1)
        self.largest = int(np.abs(table).max(initial=0))

    @classmethod
    def build(cls, ids: np.ndarray, table: np.ndarray) -> SortedLists:
        wide = table.astype(np.float64)
        return cls(ids, wide, np.argsort(wide, axis=0, kind="stable").T)

    def save(self, path: str) -> None:
        data = io.BytesIO()
        np.savez(data, ids=self.ids, table=self.table, order=self.order.astype(np.int32))
        with shared.create(path) as file:
            file.write(data.getvalue())

    @classmethod
    def load(cls, path: str) -> SortedLists:
        with shared.open_file(path) as file:
            saved = np.load(io.BytesIO(file.read()))
        return cls(saved["ids"], saved["table"], saved["order"])

    def top(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """(vec_id, score) of the k best rows without those of id ``own``."""
        query = query.astype(np.float64)
        # Sums that a double holds exactly stay doubles; others take Python's integers.
        exact = self.largest * sum(map(abs, map(int, query))) < EXACT_DOUBLES
        weights = query if exact else whole_numbers(query)
        count = len(self.ids)
        up, down = np.flatnonzero(query < 0), np.flatnonzero(query > 0)
        unseen = np.ones(count, bool)
        best_ids, best = np.empty(0, np.int64), np.empty(0, weights.dtype)
        depth, step = 0, FIRST_DEPTH
        while depth < count:
            until = min(count, depth + step)
            if len(up) or len(down):
                fresh = np.zeros(count, bool)
                fresh[self.order[up, depth:until]] = True
                fresh[self.order[down, count - until : count - depth]] = True
                fresh &= unseen
                rows = np.flatnonzero(fresh)
                unseen[rows] = False
                low, high = self.sorted[up, until - 1], self.sorted[down, count - until]
                if not exact:
                    low, high = whole_numbers(low), whole_numbers(high)
                bound = low @ weights[up] + high @ weights[down]
            else:  # a zero query scores every row alike
                rows, until, bound = np.arange(count), count, 0
            scores = (self.table[rows] if exact else whole_numbers(self.table[rows])) @ weights
            if len(best) >= k:
                hopeful = scores >= best[k - 1]
                rows, scores = rows[hopeful], scores[hopeful]
            ids = self.ids[rows]
            other = ids != own
            best_ids = np.concatenate([best_ids, ids[other]])
            best = np.concatenate([best, scores[other]])
            order = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[order], best[order]
            if len(best) == k and bound < best[-1] or not unseen.any():
                break
            depth, step = until, 2 * step
        return [(i, int(score)) for i, score in zip(best_ids.tolist(), best.tolist())]


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """Doubles that hold whole numbers, as Python's integers."""
    whole = np.empty(values.shape, object)
    whole[...] = [int(x) for x in values] if values.ndim == 1 else [[int(x) for x in row] for row in values]
    return whole


def top_scores(
    table: DataFrame,
    is_query: Column,
    *,
    k: int,
    scale: int = SCALE,
    rows_in_shard: int = ROWS_IN_SHARD,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k largest inner products."""
    vector = F.col("embedding")
    scaled = F.transform(vector, lambda x: held_exactly(F.lit(float(scale)) * x.cast("double")))
    rows = usable_rows(
        table.filter(finite(vector)).select("vec_id", scaled.alias("embedding")),
        F.lit(True),
    )
    folder = shared.shared_folder(table.sparkSession, "lists")

    def build(size: int, shard: int, group: pd.DataFrame) -> str:
        path = shared.own_name(folder, f"lists-{size}-{shard:06d}", ".npz")
        whole = np.array(group["embedding"].tolist(), np.int64)
        SortedLists.build(group["vec_id"].to_numpy(np.int64), whole).save(path)
        return path

    def find(lists: SortedLists, query: np.ndarray, own: int, k: int):
        found = lists.top(query, own, k)
        for vec_id, score in found:
            if not -(1 << 63) <= score < 1 << 63:
                raise OverflowError(f"the score of vectors {own} and {vec_id} exceeds a long")
        return found

    paths, shards = build_shards(rows, rows_in_shard, build)
    queries = rows.filter(is_query)
    return search_shards(queries, paths, shards, k, "long", SortedLists.load, find)


def held_exactly(scaled: Column) -> Column:
    """The floor of a component, refused where doubles have gaps between whole numbers."""
    refused = F.raise_error(F.lit("a scaled component reaches 2^53")).cast("long")
    return F.when(F.abs(scaled) < float(EXACT_DOUBLES), F.floor(scaled)).otherwise(refused)
