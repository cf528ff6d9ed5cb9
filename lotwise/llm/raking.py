"""Mixing documents to target weights by iterative proportional fitting.

Targets give shares of tokens to values of several columns, such as source,
language and topic. Documents are summed up in cells, one for each combination of
values; fitting multiplies the cells' weights margin by margin until every margin
has its shares; that gives a cell's factor. Documents are kept with a probability
that is fitted in the same way but stops at 1: a cell that is kept whole gives no
more, and the others of its margins make up for it. The sample is as large as the
targets allow, so the kept tokens have the target shares in expectation. A rare
value could make it tiny, so at least ``LEAST_KEPT`` of the tokens are kept: where
the targets would need less, values too rare for their share are kept whole, and
the others share what these leave open as their targets do.

Values without a target, null among them, are one value ``other`` that keeps the
share it has; the targets share the rest. Targets of values that do not occur are
spread over those that do. Documents without tokens count as one token. An empty
table stays empty. Rows are kept one to one by ``with_probability``; repeated rows
share one fate, since the draw is a hash of id and text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.llm.shared import free_name, without

OTHER = "\u0000other"
TOLERANCE = 1e-10
MAX_SWEEPS = 2000
# Cells are bounded by the targets given, not by the data; more are refused.
MAX_CELLS = 2_000_000
DRAW_BITS = 53
# Share of the tokens that is kept even if the targets cannot be met with it, how
# close a margin comes to its share, and steps and sweeps of the search for the size.
LEAST_KEPT = 0.1
CLOSE = 1e-7
SIZE_STEPS = 12
SIZE_SWEEPS = 1000


def token_count(text: Column) -> Column:
    """Words of a text: runs without white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def cell_keys(targets: dict[str, dict[str, float]]) -> dict[str, Column]:
    """Each target column's value, or OTHER where it has no target."""
    return {
        name: F.when(F.col(name).cast("string").isin(list(shares)), F.col(name).cast("string"))
        .otherwise(F.lit(OTHER))
        for name, shares in targets.items()
    }


def _margins(
    cells: list[tuple], targets: dict[str, dict[str, float]]
) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The cells' shares of all tokens; for each column, each cell's value as a number
    and the share that each value should have."""
    tokens = np.array([cell[-1] for cell in cells], np.float64)
    weights = tokens / tokens.sum()
    margins = []
    for column, shares in enumerate(targets.values()):
        names, index = np.unique([cell[column] for cell in cells], return_inverse=True)
        now = np.bincount(index, weights, len(names))
        wanted = np.array([shares.get(name, 0.0) for name in names.tolist()])
        is_other = names == OTHER
        rest = 1.0 - now[is_other].sum()
        if wanted.sum() > 0:
            wanted = np.where(is_other, now, wanted / wanted.sum() * rest)
        else:
            wanted = now
        margins.append((index, wanted))
    return weights, margins


def fit(cells: list[tuple], targets: dict[str, dict[str, float]]) -> np.ndarray:
    """The factor of each cell (values..., tokens): its new share over its old one."""
    weights, margins = _margins(cells, targets)
    fitted = weights.copy()
    for _ in range(MAX_SWEEPS):
        worst = 0.0
        for index, wanted in margins:
            now = np.bincount(index, fitted, len(wanted))
            worst = max(worst, float(np.abs(now - wanted).max()))
            scale = np.divide(wanted, now, out=np.zeros_like(now), where=now > 0)
            fitted = fitted * scale[index]
        if worst < TOLERANCE:
            break
    return fitted / weights


def _bounded(weights: np.ndarray, margins: list, size: float) -> tuple[np.ndarray, bool]:
    """Probabilities that keep the wanted tokens of each value, and whether they do.
    The wanted tokens of each margin add up to ``size``."""
    chance = np.full(len(weights), size)
    for _ in range(SIZE_SWEEPS):
        worst = 0.0
        for index, wanted in margins:
            now = np.bincount(index, weights * np.minimum(chance, 1.0), len(wanted))
            worst = max(worst, float(np.abs(now - wanted).max()))
            scale = np.divide(wanted, now, out=np.zeros_like(now), where=now > 0)
            chance = chance * scale[index]
        if worst < CLOSE * size:
            return np.minimum(chance, 1.0), True
    return np.minimum(chance, 1.0), False


def _filled(wanted: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Wanted tokens, none above what is held; what is cut goes to the other values."""
    size, full = wanted.sum(), np.zeros(len(wanted), bool)
    while True:
        open_share = wanted[~full].sum()
        left = size - held[full].sum()
        now = np.where(full, held, wanted * (left / open_share if open_share > 0 else 0.0))
        more = ~full & (now > held)
        if not more.any():
            return now
        full |= more


def keep_chances(
    cells: list[tuple], targets: dict[str, dict[str, float]], least_kept: float = LEAST_KEPT
) -> np.ndarray:
    """Each cell's probability to be kept, at most 1, for the largest sample that has
    the target shares, or for ``least_kept`` of the tokens if that is more."""
    weights, margins = _margins(cells, targets)
    held = [np.bincount(index, weights, len(wanted)) for index, wanted in margins]
    most = min(
        float((has[wanted > 0] / wanted[wanted > 0]).min()) for has, (_, wanted) in zip(held, margins)
    )
    most = min(most, 1.0)

    def at(size: float) -> tuple[np.ndarray, bool]:
        return _bounded(weights, [(index, size * wanted) for index, wanted in margins], size)

    if most >= least_kept:
        best, met = at(most)
        if met:
            return best
        best, met = at(least_kept)
        if met:
            low, high = least_kept, most
            for _ in range(SIZE_STEPS):
                middle = (low + high) / 2
                found, met = at(middle)
                low, high = (middle, high) if met else (low, middle)
                best = found if met else best
            return best
    filled = [
        (index, _filled(least_kept * wanted, has)) for has, (index, wanted) in zip(held, margins)
    ]
    return _bounded(weights, filled, least_kept)[0]


def with_probability(
    documents: DataFrame,
    targets: dict[str, dict[str, float]],
    *,
    tokens: str,
    keep_share: float = 1.0,
    least_kept: float = LEAST_KEPT,
    factor_into: str = "weight",
    into: str = "probability",
) -> DataFrame:
    """Add each document's factor and its probability to be kept.

    The probability is that of ``keep_chances`` times ``keep_share``, at most 1. Input
    columns of the two new names are replaced, in whatever case."""
    keys = cell_keys(targets)
    most = 1
    for shares in targets.values():
        most *= 1 + len(shares)
    if most > MAX_CELLS:
        raise ValueError(f"the targets make {most} cells, more than {MAX_CELLS}")
    names = [free_name(documents, f"cell_{i}") for i in range(len(keys))]
    counted = F.greatest(F.col(tokens), F.lit(1)).cast("long")
    celled = documents.withColumns(dict(zip(names, keys.values())))
    sums = celled.groupBy(*names).agg(F.sum(counted).alias("tokens")).collect()
    cells = [tuple(row) for row in sums]
    factors = fit(cells, targets) if cells else np.empty(0)
    chance = keep_share * keep_chances(cells, targets, least_kept) if cells else np.empty(0)
    rows = [(*c[:-1], float(f), float(p)) for c, f, p in zip(cells, factors, chance)]
    schema = T.StructType(
        [T.StructField(name, T.StringType()) for name in names]
        + [T.StructField(factor_into, T.DoubleType()), T.StructField(into, T.DoubleType())]
    )
    table = documents.sparkSession.createDataFrame(rows, schema)
    kept = celled.select(*without(celled, factor_into, into))
    return kept.join(F.broadcast(table), names, "left").drop(*names)


def drawn(probability: Column, *marks: Column, seed: int = 0) -> Column:
    """True with the given probability; the draw is a hash of the marks."""
    number = F.xxhash64(*marks, F.lit(seed)).bitwiseAND(F.lit((1 << DRAW_BITS) - 1))
    return number / F.lit(float(1 << DRAW_BITS)) < probability
