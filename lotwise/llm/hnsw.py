"""Approximate nearest neighbours: a navigable small-world graph per shard.

A shard's graph is kept as flat arrays: vectors, ids, and for each layer a table of
neighbour numbers. Equal vectors are one node, so that crowds of copies cannot cut
the graph apart; a node's ids lie in one ascending array. Each query searches every
shard, the shards' results are scored exactly in double precision and ranked
together, ties by the smaller ``vec_id``.

Vectors that are null, empty, zero or hold null or non-finite components take no
part. See ``vectors`` for repeated rows and lengths.
"""

from __future__ import annotations

import heapq
import io
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm import shared
from lotwise.llm.vectors import build_shards, finite, search_shards, usable_rows

ROWS_IN_SHARD = 8192
NEIGHBOURS = 16
BUILD_WIDTH = 64
SEARCH_WIDTH = 64


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows as doubles, each divided by a power of two that brings its largest component
    to between a half and 1. Cosines stay as they are and no square overflows."""
    wide = vectors.astype(np.float64)
    powers = np.frexp(np.abs(wide).max(axis=1))[1]
    return np.ldexp(wide, -powers[:, None])


class Graph:
    """``links[layer]`` has a row of neighbour numbers for each node, -1 where none."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, starts: np.ndarray):
        self.vectors, self.ids, self.starts = vectors, ids, starts
        wide = scaled(vectors)
        self.lengths = np.sqrt((wide * wide).sum(axis=1))
        self.units = (wide / self.lengths[:, None]).astype(np.float32)
        self.links: list[np.ndarray] = []
        self.entry = 0
        self.seen = np.zeros(len(vectors), np.int64)
        self.round = 0

    # Building

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> Graph:
        distinct, node = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, node.ravel()))
        starts = np.searchsorted(node.ravel()[order], np.arange(len(distinct) + 1))
        graph = cls(distinct, ids[order], starts)
        # Layers thin out by a factor of NEIGHBOURS; who stands how high is fixed.
        chance = np.random.default_rng(0).random(len(distinct))
        tops = (-np.log(1 - chance) / math.log(NEIGHBOURS)).astype(int)
        for layer in range(int(tops.max()) + 1):
            room = NEIGHBOURS * (2 if layer == 0 else 1)
            graph.links.append(np.full((len(distinct), room), -1, np.int32))
        order = np.random.default_rng(1).permutation(len(distinct))
        graph.entry, top = int(order[0]), int(tops[order[0]])
        for number in order[1:].tolist():
            top = graph._insert(number, int(tops[number]), top)
        return graph

    def _insert(self, number: int, height: int, top: int) -> int:
        unit = self.units[number]
        near = [(self._far(unit, self.entry), self.entry)]
        for layer in range(top, height, -1):
            near = self._layer(unit, near, 1, layer)
        for layer in range(min(top, height), -1, -1):
            near = self._layer(unit, near, BUILD_WIDTH, layer)
            chosen = self._spread([n for _, n in near], [d for d, _ in near], NEIGHBOURS)
            self.links[layer][number, : len(chosen)] = chosen
            for other in chosen:
                self._tie(layer, other, number)
        if height > top:
            self.entry = number
        return max(top, height)

    def _tie(self, layer: int, node: int, new: int) -> None:
        row = self.links[layer][node]
        if row[-1] < 0:
            row[np.argmax(row < 0)] = new
            return
        others = np.append(row, new)
        far = -(self.units[others] @ self.units[node])
        order = np.argsort(far, kind="stable")
        chosen = self._spread(others[order].tolist(), far[order].tolist(), len(row))
        row[:] = -1
        row[: len(chosen)] = chosen

    def _spread(self, nodes: list[int], far: list[float], room: int) -> list[int]:
        """The nearest nodes that are not nearer to one chosen before; then the rest."""
        among = -(self.units[nodes] @ self.units[nodes].T)
        nearest = np.full(len(nodes), np.inf)
        chosen, passed = [], []
        for i, distance in enumerate(far):
            if len(chosen) == room:
                break
            if distance < nearest[i]:
                chosen.append(nodes[i])
                np.minimum(nearest, among[i], out=nearest)
            else:
                passed.append(nodes[i])
        return chosen + passed[: room - len(chosen)]

    # Searching

    def _far(self, unit: np.ndarray, node: int) -> float:
        return -float(self.units[node] @ unit)

    def _layer(self, unit, near: list[tuple], width: int, layer: int) -> list[tuple]:
        """The ``width`` nearest nodes of a layer that a best-first walk finds."""
        self.round += 1
        links, seen, mark = self.links[layer], self.seen, self.round
        seen[[n for _, n in near]] = mark
        ahead = list(near)
        heapq.heapify(ahead)
        best = [(-d, n) for d, n in near]
        heapq.heapify(best)
        while ahead:
            distance, node = heapq.heappop(ahead)
            if len(best) >= width and distance > -best[0][0]:
                break
            others = links[node]
            others = others[(others >= 0) & (seen[others] != mark)]
            if not len(others):
                continue
            seen[others] = mark
            for d, n in zip((-(self.units[others] @ unit)).tolist(), others.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (-d, n))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, n))
                else:
                    continue
                heapq.heappush(ahead, (d, n))
        return sorted((-d, n) for d, n in best)

    def search(self, vector: np.ndarray, own: int, k: int, width: int) -> list[tuple[int, float]]:
        """(vec_id, cosine) of the k nearest rows found, without those of id ``own``."""
        wide = scaled(vector[None, :])[0]
        length = math.sqrt((wide * wide).sum())
        unit = (wide / length).astype(np.float32)
        near = [(self._far(unit, self.entry), self.entry)]
        for layer in range(len(self.links) - 1, 0, -1):
            near = self._layer(unit, near, 1, layer)
        nodes = np.array([n for _, n in self._layer(unit, near, max(width, k + 1), 0)])
        dots = (scaled(self.vectors[nodes]) * wide).sum(axis=1)
        scores = dots / (self.lengths[nodes] * length)
        rows = []
        for score, node in zip(scores.tolist(), nodes.tolist()):
            first, last = self.starts[node], self.starts[node + 1]
            ids = self.ids[first : min(last, first + k + 1)].tolist()
            rows += [(-score, i) for i in ids if i != own]
        return [(i, -score) for score, i in sorted(rows)[:k]]

    # Files

    def save(self, path: str) -> None:
        data = io.BytesIO()
        layers = {f"links{i}": rows for i, rows in enumerate(self.links)}
        np.savez(
            data,
            vectors=self.vectors,
            ids=self.ids,
            starts=self.starts,
            entry=np.array(self.entry),
            **layers,
        )
        with shared.create(path) as file:
            file.write(data.getvalue())

    @classmethod
    def load(cls, path: str) -> Graph:
        with shared.open_file(path) as file:
            saved = np.load(io.BytesIO(file.read()))
        graph = cls(saved["vectors"], saved["ids"], saved["starts"])
        layers = sum(name.startswith("links") for name in saved.files)
        graph.links = [saved[f"links{i}"] for i in range(layers)]
        graph.entry = int(saved["entry"])
        return graph


def nearest(
    table: DataFrame,
    is_query: Column,
    *,
    k: int,
    rows_in_shard: int = ROWS_IN_SHARD,
    search_width: int = SEARCH_WIDTH,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows found nearest by cosine."""
    vector = F.col("embedding")
    rows = usable_rows(table, finite(vector) & F.exists(vector, lambda x: x != 0))
    folder = shared.shared_folder(table.sparkSession, "graphs")

    def build(size: int, shard: int, group: pd.DataFrame) -> str:
        path = shared.own_name(folder, f"graph-{size}-{shard:06d}", ".npz")
        vectors = np.array(group["embedding"].tolist())
        Graph.build(group["vec_id"].to_numpy(np.int64), vectors).save(path)
        return path

    def find(graph: Graph, query: np.ndarray, own: int, k: int):
        return graph.search(query, own, k, search_width)

    paths, shards = build_shards(rows, rows_in_shard, build)
    queries = rows.filter(is_query)
    return search_shards(queries, paths, shards, k, "double", Graph.load, find)
