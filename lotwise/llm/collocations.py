"""Phrase collocations by Toivonen's sampling method.

A phrase is a run of words inside a piece of text; pieces end at punctuation marks and
line breaks. Phrases of up to ``longest`` words that occur ``least`` times or more in
their language are found in these passes:

1. A sample of the documents proposes phrases: those that reach a lowered count in it.
2. A full pass counts, exactly and together, every proposed phrase and its negative
   border: what is not proposed while both phrases that lack its first or its last word
   are. (For words the border is every other word.) Proposals are closed under leaving
   out a first or last word, so "both are proposed" selects exactly these.
3. Frequent phrases of the border are border failures: longer phrases that hold them have
   not been counted. They join the proposals, and an expansion pass counts what that adds
   to the border, and nothing else. It extends what it counts at once, whether frequent or
   not: that is little, and spares a pass for each further word. Passes go on until every
   frequent phrase has been extended.

The sample decides how many passes there are and nothing else: counts, totals and scores
come from full passes over whole texts.

Tasks know the proposals as Bloom filters of ``FILTER_BYTES`` each at most, whatever
their number; a phrase that a filter passes wrongly is only counted too. Each task counts
in chunks over numbers of distinct words, so no hash decides a count; the counts of
chunks are added up before they are shuffled, and a phrase or a language that a third of
all rows holds is no hot key.

Null and empty texts have no words. A null language is ``und``. Repeated rows count as
often as they are there; null ids and further columns change nothing but the choice of
the sample. Chunks are of whole texts: a very long text is a chunk of its own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.filters import empty_filter, filled
from lotwise.llm.shared import byte_slices, whole_text
from lotwise.llm.url_rules import Level
from lotwise.operators.tables import stored

# Signs that end a piece, signs between words, the unknown language.
PIECE_ENDS = b".,;:!?\n\v\f\r"
BLANKS = b" \t"
UNKNOWN = "und"

# The sample's share of documents, and the share of the count expected in it that a
# proposed phrase must reach.
SAMPLE_PERCENT = 10
LOWERED = 0.6
FILTER_BYTES = 16 << 20
CHUNK_BYTES = 4 << 20

# Never part of UTF-8, so no text holds it: it stands between pieces.
MARK = b"\xff"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
FOLDED = bytes.maketrans(
    _UPPER + PIECE_ENDS + BLANKS, _LOWER + MARK * len(PIECE_ENDS) + b" " * len(BLANKS)
)
_FACTORS = np.random.default_rng(12).integers(0, 1 << 64, (2, 16), np.uint64) | np.uint64(1)

# What a phrase is counted under, as one string, which is half as large in an aggregation
# as its columns: whether it is extended (or a total), the length of the language's
# name, a colon, that name, the phrase.
PLAIN, EXTENDED, TOTAL = "012"
COUNTS = "name string, n long"

# One filter for each size of proposed phrases.
Filters = list[Level]


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))


def phrase_hashes(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each phrase, from the hashes of its first words, second words, ..."""
    terms = [[part * f for part, f in zip(parts, factors)] for factors in _FACTORS]
    first, second = (reduce(np.add, some) for some in terms)
    return first, second


def _proposed(rounds: list[Filters], size: int, parts: list[np.ndarray]) -> np.ndarray:
    """Which phrases some round proposed; all of them where there has been none."""
    if not rounds:
        return np.ones(len(parts[0]), bool)
    h1, h2 = phrase_hashes(parts)
    return reduce(np.logical_or, (filters[size - 1].passes(h1, h2) for filters in rounds))


def count_phrases(
    texts: list[bytes], lang: str, *, longest: int, rounds: list[Filters], counted: list[Filters] | None
) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """Size, phrases, whether longer ones are counted that begin or end with them, and
    counts, for phrases both of whose parts ``rounds`` proposed.

    An expansion names the rounds of earlier passes in ``counted``: phrases counted then
    are left out, and those counted now are extended like proposed ones. Size 0 is the
    number of words."""
    spaced = MARK.join([*texts, b""]).translate(FOLDED).replace(MARK, b" " + MARK + b" ")
    split = pc.split_pattern(pa.array([spaced], pa.large_binary()), b" ")
    spelled, ids = _numbered(split.flatten())
    empty, mark = (pc.index(spelled, sign).as_py() for sign in (b"", MARK))
    ids = ids[ids != empty]
    word = np.ones(len(spelled), bool)
    word[[empty, mark]] = False
    inside = word[ids]
    hashes = word_hashes(spelled.to_pylist(), lang)
    now = _proposed(rounds, 1, [hashes])
    then = _proposed(counted, 1, [hashes]) if counted is not None else np.zeros(len(hashes), bool)
    if counted is None:
        yield 0, pa.array([b""], spelled.type), np.array([True]), np.array([inside.sum()])
        known = np.flatnonzero(word)
        yield 1, spelled.take(pa.array(known)), now[known], np.bincount(ids, minlength=len(spelled))[known]
    # At each position the number of the phrase that begins there, or -1.
    at = np.where(inside, ids, -1)
    for size in range(2, longest + 1):
        left, right = at[:-1], at[1:]
        both = np.flatnonzero((left >= 0) & (right >= 0))
        both = both[now[left[both]] & now[right[both]]]
        if not len(both):
            return
        keys, which = _numbered(pa.array(left[both] * len(spelled) + ids[both + size - 1]))
        begins = np.empty(len(keys), np.int64)
        begins[which] = both
        before = then[left[begins]] & then[right[begins]]
        now, then = np.ones(len(keys), bool), before
        if size < longest:
            parts = [hashes[ids[begins + j]] for j in range(size)]
            now = _proposed(rounds, size, parts)
            if counted is not None:
                now |= ~before
                then = before & _proposed(counted, size, parts)
        new = np.flatnonzero(~before)
        if len(new):
            columns = [spelled.take(pa.array(ids[begins[new] + j])) for j in range(size)]
            phrases = pc.binary_join_element_wise(*columns, pa.scalar(b" ", spelled.type))
            yield size, phrases, now[new], np.bincount(which, minlength=len(keys))[new]
        at = np.full(len(at) - 1, -1)
        at[both] = which


def _numbered(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct values, and for each value its place among them."""
    encoded = values.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)


def pass_over(
    texts: DataFrame, *, longest: int, rounds: list[Filters], counted: list[Filters] | None
) -> DataFrame:
    """(name, n) of one pass over texts (lang, text)."""
    held = texts.sparkSession.sparkContext.broadcast((rounds, counted))

    def run(incoming):
        now, then = held.value
        for whole in incoming:
            for batch in byte_slices(whole, CHUNK_BYTES):
                groups = defaultdict(list)
                langs, bodies = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
                for lang, text in zip(langs, bodies.to_pylist()):
                    groups[lang].append(text)
                for lang, some in groups.items():
                    heads = pa.array([f"{kind}{len(lang)}:{lang}" for kind in (PLAIN, EXTENDED, TOTAL)])
                    found = count_phrases(some, lang, longest=longest, rounds=now, counted=then)
                    for size, phrases, extended, counts in found:
                        head = heads.take(pa.array(extended.astype(np.int32) if size else [2]))
                        names = pc.binary_join_element_wise(head, phrases.cast(pa.string()), "")
                        yield pa.RecordBatch.from_arrays(
                            [names, pa.array(counts, pa.int64())], names=["name", "n"]
                        )
                pa.default_memory_pool().release_unused()

    parts = texts.select("lang", "text").mapInArrow(run, COUNTS)
    return parts.groupBy("name").agg(F.sum("n").alias("n"))


def named_parts(counts: DataFrame) -> DataFrame:
    """(lang, size, phrase, extended, n) of (name, n)."""
    kind, colon = F.substring("name", 1, 1), F.instr("name", ":")
    wide = F.expr("cast(substring(name, 2, instr(name, ':') - 2) as int)")
    phrase = F.substring(F.col("name"), colon + 1 + wide, F.length("name"))
    size = F.when(kind == TOTAL, F.lit(0)).otherwise(F.size(F.split(phrase, " ", -1)))
    return counts.select(
        F.substring(F.col("name"), colon + 1, wide).alias("lang"),
        size.alias("size"),
        phrase.alias("phrase"),
        (kind != PLAIN).alias("extended"),
        "n",
    )


def filters_of(phrases: DataFrame, longest: int) -> Filters:
    """One Bloom filter for each size below ``longest``, over (lang, size, phrase)."""
    sizes = dict(phrases.groupBy("size").count().collect())
    made = []
    for size in range(1, longest):
        empty = empty_filter(size, sizes.get(size, 0), FILTER_BYTES)
        of_size = phrases.filter(F.col("size") == size).select("lang", "phrase")
        made.append(filled(empty, of_size, _hashes_by_language) if sizes.get(size) else empty)
    return made


def _hashes_by_language(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    groups = defaultdict(list)
    for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        groups[lang].append(phrase.encode("utf-8", "surrogatepass").split(b" "))
    return [
        phrase_hashes([word_hashes([*part], lang) for part in zip(*some)])
        for lang, some in groups.items()
    ]


def frequent_phrases(
    documents: DataFrame,
    *,
    least: int,
    longest: int = 4,
    sample_percent: int = SAMPLE_PERCENT,
    lowered: float = LOWERED,
) -> tuple[DataFrame, int]:
    """(lang, size, phrase, n) of every phrase that occurs ``least`` times or more in its
    language, and of size 0 the number of words of every language; and how many full
    passes it took."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    texts = documents.select(lang, whole_text().alias("text"), F.xxhash64("doc_id", "text").alias("draw"))
    sample = texts.filter(F.pmod("draw", F.lit(100)) < sample_percent)
    enough = max(1, round(least * sample_percent / 100 * lowered))
    tried = pass_over(sample, longest=longest - 1, rounds=[], counted=None)
    proposed = stored(named_parts(tried.filter(F.col("n") >= enough)).filter("size > 0"))
    rounds, counted, found = [filters_of(proposed, longest)], None, []
    while True:
        counts = pass_over(texts, longest=longest, rounds=rounds, counted=counted)
        listed = counts.filter((F.col("n") >= least) | F.col("name").startswith(TOTAL))
        found.append(stored(named_parts(listed)))
        failures = found[-1].filter((F.col("size") < longest) & ~F.col("extended"))
        if failures.isEmpty():
            return reduce(DataFrame.union, found).drop("extended"), len(found)
        counted = rounds
        rounds = [*rounds, filters_of(failures, longest)]


def _long(column: str) -> Column:
    """A count in arithmetic whose products may pass 64 bits."""
    return F.col(column).cast("decimal(20,0)")


def scored(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, n, score) of phrases of two words or more: the cut in
    two with the least score, of equal ones the first."""
    totals = frequent.filter("size = 0").select("lang", F.col("n"))
    counts = frequent.filter("size > 0").select("lang", "size", "phrase", F.col("n").alias("a"))
    words = F.split("phrase", " ", -1)
    cuts = counts.filter("size > 1").select(
        "*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    )
    cut = cuts.withColumns(
        {
            "first": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "),
            "rest": F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " "),
        }
    )
    of_first, of_rest = (
        counts.select("lang", F.col("phrase").alias(part), F.col("a").alias(name))
        for part, name in (("first", "l"), ("rest", "r"))
    )
    weighed = (
        cut.join(of_first, ["lang", "first"])
        .join(of_rest, ["lang", "rest"])
        .withColumns({"_a": _long("a"), "_l": _long("l"), "_r": _long("r")})
        .withColumn("score", F.expr("(_a * 2000000BD) div (_l + _r)"))
    )
    best = weighed.groupBy("lang", "phrase").agg(
        F.first("size").alias("size"),
        F.first("a").alias("a"),
        F.min(F.struct("score", "k", "l", "r")).alias("cut"),
    )
    return best.join(totals, "lang").select(
        "lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score"
    )


def outlived(candidates: DataFrame, percent: int) -> DataFrame:
    """Candidates but those that lie in a longer one with ``percent`` of their count."""
    words = F.split("phrase", " ", -1)
    longer = candidates.filter("size > 2").select(
        "lang",
        F.col("a").alias("of_longer"),
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("size") - 1),
                    lambda width: F.transform(
                        F.sequence(F.lit(1), F.col("size") - width + 1),
                        lambda start: F.array_join(F.slice(words, start, width), " "),
                    ),
                )
            )
        ).alias("phrase"),
    )
    most = longer.groupBy("lang", "phrase").agg(F.max("of_longer").alias("of_longer"))
    held = _long("of_longer") * 100 >= _long("a") * percent
    kept = candidates.join(most, ["lang", "phrase"], "left")
    return kept.filter(~F.coalesce(held, F.lit(False))).drop("of_longer")


def collocations(
    documents: DataFrame, *, least: int, longest: int = 4, percent: int = 80, **sampling
) -> DataFrame:
    """(lang, phrase, size, a, l, r, n, score) of documents (doc_id, text, lang): all
    candidates that no longer one outweighs."""
    frequent, _ = frequent_phrases(documents, least=least, longest=longest, **sampling)
    return outlived(stored(scored(frequent)), percent)
