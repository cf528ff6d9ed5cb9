"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent character n-grams, most
frequent first, counted over labelled documents. A document's own list is compared
with each profile: an n-gram is out of place by the difference of its two ranks,
or by the profile's full length where the profile lacks it. The language with the
least sum is predicted, of equals the first by name.

N-grams have one to three letters, lower-cased, and do not cross word borders; the
border itself counts as a letter. Null texts and texts without a letter are
``und`` with score 0, as is everything where no language was learned. The score is
one minus the mean displacement as a part of the profile's length. Rows without a
language teach nothing. Rows are kept one to one.
"""

from __future__ import annotations

import functools
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.llm.shared import without

PROFILE = 300
UNKNOWN = "und"
BORDER = 32
LETTER_BITS = 21
# A learning task hands its counts on when it holds this many n-grams.
HELD_GRAMS = 1 << 21


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """The lower-case letter of every code point; a border where there is no letter."""
    table = np.full(sys.maxunicode + 1, BORDER, np.uint32)
    for point in range(sys.maxunicode + 1):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def letter_codes(text: str) -> np.ndarray:
    """Letters with one border before, after and between words; empty without letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.concatenate([[BORDER], letters()[points], [BORDER]]).astype(np.int64)
    kept = codes[np.append(True, (codes[1:] != BORDER) | (codes[:-1] != BORDER))]
    return kept if len(kept) > 1 else kept[:0]


def grams(codes: np.ndarray) -> np.ndarray:
    """All n-grams as numbers; longer ones are larger, so none are confused."""
    two = (codes[:-1] << LETTER_BITS) | codes[1:]
    three = (two[:-1] << LETTER_BITS) | codes[2:]
    return np.concatenate([codes[codes != BORDER], two, three[codes[1:-1] != BORDER]])


def counted(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(numbers, return_counts=True)


def frequent(codes: np.ndarray, length: int = PROFILE) -> np.ndarray:
    """A text's n-grams, most frequent first, of equals the smaller number."""
    found, times = counted(grams(codes))
    if len(found) > length:
        least = np.partition(times, len(times) - length)[len(times) - length]
        found, times = found[times >= least], times[times >= least]
    return found[np.argsort(-times, kind="stable")][:length]


class Profiles:
    """Ranks of all known n-grams in every language, in one table."""

    def __init__(self, ranked: dict[str, list[int]], length: int = PROFILE):
        self.names = sorted(ranked)
        self.length = length
        self.known = np.unique(np.concatenate([np.array(ranked[n], np.int64) for n in self.names]))
        self.ranks = np.full((len(self.names), len(self.known)), -1, np.int64)
        for row, name in enumerate(self.names):
            at = np.searchsorted(self.known, ranked[name])
            self.ranks[row, at] = np.arange(len(at))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = letter_codes(text or "")
        if not len(codes):
            return UNKNOWN, 0.0
        own = frequent(codes, self.length)
        at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        ranks = np.where(self.known[at] == own, self.ranks[:, at], -1)
        away = np.where(ranks < 0, self.length, np.abs(ranks - np.arange(len(own))))
        sums = away.sum(axis=1)
        best = int(np.argmin(sums))
        return self.names[best], 1.0 - float(sums[best]) / (self.length * len(own))


def learn(
    documents: DataFrame, *, text: str = "text", lang: str = "lang", length: int = PROFILE
) -> Profiles | None:
    """Profiles of every language among the documents; None if there is none.

    Counts are summed up within tasks before they are shuffled. The driver gets the
    profiles only, ``length`` n-grams a language."""

    def count(incoming):
        held: dict[str, list] = {}
        size = 0
        for batch in incoming:
            for label, content in zip(*(column.to_pylist() for column in batch.columns)):
                codes = letter_codes(content)
                if not len(codes):
                    continue
                parts = held.setdefault(label, [])
                parts.append(grams(codes))
                size += len(parts[-1])
                if size >= HELD_GRAMS:
                    yield from _counts(held)
                    held, size = {}, 0
        yield from _counts(held)

    labelled = documents.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    totals = (
        labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
        .mapInArrow(count, "lang string, gram long, times long")
        .groupBy("lang", "gram")
        .agg(F.sum("times").alias("times"))
    )
    place = F.expr("row_number() over (partition by lang order by times desc, gram)")
    top = totals.withColumn("place", place).filter(F.col("place") <= length)
    ranked: dict[str, list[int]] = {}
    for row in sorted(top.select("lang", "place", "gram").collect()):
        ranked.setdefault(row["lang"], []).append(row["gram"])
    return Profiles(ranked, length) if ranked else None


def _counts(held: dict[str, list]):
    for label, parts in held.items():
        found, times = counted(np.concatenate(parts))
        yield pa.RecordBatch.from_arrays(
            [pa.array([label] * len(found)), pa.array(found), pa.array(times.astype(np.int64))],
            names=["lang", "gram", "times"],
        )


def identify(
    documents: DataFrame,
    profiles: Profiles | None,
    *,
    text: str = "text",
    lang_into: str = "lang_pred",
    score_into: str = "score",
) -> DataFrame:
    """Add the predicted language and its score; columns of these names are replaced, in
    whatever case. Whole texts are read, very long ones too."""
    new = (lang_into, score_into)
    kept = without(documents, *new)
    place = kept.index(text)
    held = documents.sparkSession.sparkContext.broadcast(profiles)

    def run(incoming):
        known = held.value
        for batch in incoming:
            texts = (value.as_py() for value in batch.column(place))
            found = [known.predict(t) if known else (UNKNOWN, 0.0) for t in texts]
            names, scores = [f[0] for f in found], [f[1] for f in found]
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *new])

    frame = documents.select(*kept)
    fields = [T.StructField(lang_into, T.StringType()), T.StructField(score_into, T.DoubleType())]
    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, *fields]))
