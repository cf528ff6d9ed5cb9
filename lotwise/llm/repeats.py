"""Repeated passages by compaction of a de Bruijn graph.

A window is ``length`` consecutive words of one text. It is an edge, from the node of its
first ``length - 1`` words to that of its last; equal windows are one edge. A window is a
repeat if its edge has an occurrence that starts earlier: in a smaller ``doc_id`` or
further ahead in the same document. Words covered by a repeat are removed; windows are
judged on the whole input, not on what is left.

1. Copies of a whole text need no graph: only the first goes on, and a later one of
   ``length`` words or more is removed whole.
2. Of the shingles in a window that with the least hash stands for it. Equal windows have
   equal least shingles, so only windows whose least shingle occurs twice are edges. Tasks
   know those as a Bloom filter of ``FILTER_BYTES`` at most.
3. Edges are counted, and get the coordinates of their first occurrence: the source.
4. Paths on which no node branches are compacted. Neighbouring edges with neighbouring
   sources make a piece; where a path goes on in another text, pieces are joined by
   doubling pointers, a Spark join a round. Pieces on a cycle stay apart.
5. Repeats that follow one path, from one stretch of source, are one span. Every span is
   verified: its words are compared, in blocks that begin at fixed source positions, by a
   128-bit digest with the words at the source. If a hash has misled, all is done again
   with other hashes.

Nodes and edges are 64 and 128 bits wide. A passage that a third of all rows holds is
counted before it is shuffled; joins on it can be cut by the skew join. A row's spans are
gathered by text, whose size bounds them; blocks bound how many a source has.

Null and empty texts have no words; a text shorter than a window loses none. Rows are
ordered by id, null ids last, then by a digest of the text. Of rows that repeat an id and
a text one counts as first. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotwise.llm.filters import empty_filter, filled
from lotwise.llm.shared import byte_slices, whole_text
from lotwise.llm.url_rules import Level
from lotwise.operators.tables import stored
from lotwise.session import new_folder, remove_folder

# Signs between words.
BLANKS = b" \t\n\v\f\r"

FILTER_BYTES = 32 << 20
CHUNK_BYTES = 2 << 20
# A coordinate is a text's number of slots before it, and a word's place. A text of more
# words than a slot holds has several.
SLOT_BITS = 24
# Bytes whose words are hashed together, and those beyond which a word is hashed by itself.
PIECE_BYTES = 1 << 18
LONG_WORD = 256
# Words a verified block has at most.
BLOCK = 64
SEEDS = range(1, 4)

# Never part of UTF-8, so no text holds it: it stands between texts.
MARK = b"\xff"
SPACED = bytes.maketrans(BLANKS, b" " * len(BLANKS))


class Hashes:
    """Hash functions of one seed, for windows of ``length`` words."""

    def __init__(self, seed: int, length: int):
        self.seed, self.length = seed, length
        self.shingle = max(1, 2 * length // 5)
        self.factors = np.random.default_rng(seed).integers(0, 1 << 64, (2, length), np.uint64)
        self.factors |= np.uint64(1)
        draw = np.random.default_rng([seed, 1])
        self.signs = draw.integers(0, 1 << 64, 256, np.uint64)
        root = int(draw.integers(0, 1 << 61)) * 8 + 3
        self.powers, self.inverses = (
            np.cumprod(np.concatenate([[np.uint64(1)], np.full(PIECE_BYTES, number, np.uint64)]))
            for number in (root, pow(root, -1, 1 << 64))
        )

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A hash of every word, and the number of words up to the end of each text."""
        between = b" " + MARK + b" "
        spaced = b" " + between.join([*texts, b""]).translate(SPACED)
        signs = np.frombuffer(spaced, np.uint8)
        edge = np.flatnonzero(np.diff(signs != ord(" "), append=False)) + 1
        starts, ends = edge[::2], edge[1::2]
        hashes = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            until = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE_BYTES, "right")))
            hashes[at:until] = self._of_piece(signs, starts[at:until], ends[at:until])
            at = until
        for i in np.flatnonzero(ends - starts > LONG_WORD):
            hashes[i] = xxhash.xxh64_intdigest(spaced[starts[i] : ends[i]], self.seed)
        mark = signs[starts] == MARK[0]
        marks = np.flatnonzero(mark)
        return hashes[~mark], marks - np.arange(len(marks))

    def _of_piece(self, signs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Polynomials of words that lie near each other, from sums over all their signs."""
        first, size = int(starts[0]), int(ends[-1] - starts[0])
        if size > PIECE_BYTES:
            return np.zeros(len(starts), np.uint64)
        terms = self.signs[signs[first : first + size]] * self.powers[:size]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
        hashes = (sums[ends - first] - sums[starts - first]) * self.inverses[starts - first]
        hashes ^= hashes >> np.uint64(32)
        hashes *= np.uint64(0x94D049BB133111EB)
        return hashes ^ hashes >> np.uint64(29)

    def _summed(self, words: np.ndarray, width: int, row: int) -> np.ndarray:
        total = np.zeros(len(words) - width + 1, np.uint64)
        for j in range(width):
            total += words[j : j + len(total)] * self.factors[row, j]
        return total

    def nodes(self, words: np.ndarray) -> np.ndarray:
        return self._summed(words, self.length - 1, 0)

    def windows(self, words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where windows begin, the text of each, the least shingle hash in each, and the
        hashes of the shingles that are the least of some window."""
        sizes = np.diff(ends, prepend=0)
        last = self.length - 1
        if len(words) < self.length:
            return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),) * 2
        text = np.repeat(np.arange(len(sizes)), sizes)
        inside = text[: len(text) - last] == text[last:]
        mixed = self._summed(words, self.shingle, 1)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(27)
        width = self.length - self.shingle + 1
        least = _sliding(np.minimum, mixed, width)
        begins = np.flatnonzero(inside)
        # A shingle is the least of a window if the largest least around it is its own.
        around = np.zeros(len(least) + 2 * (width - 1), np.uint64)
        around[width - 1 : width - 1 + len(least)][inside] = least[inside]
        chosen = mixed[_sliding(np.maximum, around, width) == mixed]
        return begins, text[begins], least[begins], chosen


def _sliding(pick: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """The least or largest of every ``width`` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        values = pick(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def _pair(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = values.astype(np.uint64)
    return first, first * np.uint64(0x9E3779B97F4A7C15) ^ first >> np.uint64(29)


def _chunks(incoming: Iterator[pa.RecordBatch], hashes: Hashes) -> Iterator[tuple]:
    """(base, ends, words) of batches (base, text)."""
    for whole in incoming:
        for batch in byte_slices(whole, CHUNK_BYTES):
            bases, texts = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
            words, ends = hashes.words(texts)
            yield bases.to_numpy(zero_copy_only=False), ends, words
            pa.default_memory_pool().release_unused()


def least_shingles(texts: DataFrame, hashes: Hashes) -> DataFrame:
    """(value): one row for each place of a shingle that is the least of a window."""

    def run(incoming):
        for _, ends, words in _chunks(incoming, hashes):
            chosen = hashes.windows(words, ends)[-1].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(chosen)], names=["value"])

    return texts.select("base", "text").mapInArrow(run, "value long")


def repeated_filter(texts: DataFrame, hashes: Hashes) -> Level:
    counted = least_shingles(texts, hashes).groupBy("value").count()
    repeated = stored(counted.filter("count > 1").select("value"))
    empty = empty_filter(0, repeated.count(), FILTER_BYTES)
    return filled(empty, repeated, lambda batch: [_pair(batch.column(0).to_numpy())])


def edges(texts: DataFrame, hashes: Hashes, sieve: Level) -> DataFrame:
    """(l, r, at, base) for every window that may have an equal one."""
    held = texts.sparkSession.sparkContext.broadcast(sieve)
    names = ["l", "r", "at", "base"]

    def run(incoming):
        for bases, ends, words in _chunks(incoming, hashes):
            begins, text, least, _ = hashes.windows(words, ends)
            if not len(begins):
                continue
            # Neighbouring windows mostly share their least shingle.
            new = np.diff(least, prepend=~least[:1]) != 0
            kept = held.value.passes(*_pair(least[new]))[np.cumsum(new) - 1]
            begins, text = begins[kept], text[kept]
            nodes = hashes.nodes(words).view(np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            base = bases[text]
            columns = [nodes[begins], nodes[begins + 1], base + begins - starts[text], base]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return texts.select("base", "text").mapInArrow(run, "l long, r long, at long, base long")


class Scratch:
    """Tables of one attempt in the shared folder, removed as soon as nothing needs them."""

    def __init__(self, spark):
        self.spark, self.folders = spark, []

    def keep(self, frame: DataFrame) -> DataFrame:
        folder = new_folder(self.spark, "repeats")
        frame.write.option("compression", "zstd").parquet(folder)
        self.folders.append(folder)
        return self.spark.read.schema(frame.schema).parquet(folder)

    def drop_all_but(self, last: int) -> None:
        gone = self.folders[: len(self.folders) - last]
        self.folders = self.folders[len(gone) :]
        for folder in gone:
            remove_folder(self.spark, folder)


def compacted(graph: DataFrame, scratch: Scratch) -> DataFrame:
    """(l, r, at, path, place): path and place on it, for edges (l, r, at)."""
    before = graph.groupBy(F.col("r").alias("node")).agg(
        F.count("*").alias("n_in"), F.min("at").alias("before")
    )
    after = graph.groupBy(F.col("l").alias("node")).agg(
        F.count("*").alias("n_out"), F.min("at").alias("at")
    )
    links = before.filter("n_in = 1").join(after.filter("n_out = 1"), "node").select("before", "at")
    follows = (F.col("before") == F.col("at") - 1) & (F.col("at") % (1 << SLOT_BITS) != 0)
    linked = graph.join(links, "at", "left").withColumn("head", ~F.coalesce(follows, F.lit(False)))
    along = (
        Window.partitionBy(F.shiftright("at", SLOT_BITS))
        .orderBy("at")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    pieces = scratch.keep(
        linked.withColumn("piece", F.max(F.when(F.col("head"), F.col("at"))).over(along)).select(
            "l", "r", "at", "piece", F.when(F.col("head"), F.col("before")).alias("before")
        )
    )
    ends = pieces.select(F.col("at").alias("before"), F.col("piece").alias("up"))
    pointers = pieces.filter("before is not null").select("piece", "before").join(ends, "before")
    far = (F.col("before") - F.col("up") + 1).alias("far")
    roots = path_roots(stored(pointers.select("piece", "up", far)))
    placed = pieces.join(roots, "piece", "left")
    return placed.select(
        "l",
        "r",
        "at",
        F.coalesce("up", "piece").alias("path"),
        (F.coalesce("far", F.lit(0)) + F.col("at") - F.col("piece")).alias("place"),
    )


def path_roots(pointers: DataFrame) -> DataFrame:
    """(piece, up, far): the first piece of the path and the edges up to it, for pieces
    with one predecessor ``up`` that is ``far`` edges long. Pieces on a cycle are left out.

    As long as a path has pieces whose pointer moves, fewer do in each round; when as many
    move as before, all of them are on cycles."""
    before, moving = None, None
    while moving != 0 and (before is None or moving != before):
        step = pointers.select(
            F.col("piece").alias("up"), F.col("up").alias("next"), F.col("far").alias("more")
        )
        joined = pointers.select("piece", "up", "far").join(step, "up", "left")
        pointers = stored(
            joined.select(
                "piece",
                F.coalesce("next", "up").alias("up"),
                (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"),
                F.col("next").isNotNull().alias("moves"),
            )
        )
        before, moving = moving, pointers.filter("moves").count()
    return pointers.filter("not moves").drop("moves")


def spans_of(repeats: DataFrame) -> DataFrame:
    """(base, start, n, source) of maximal runs of repeats (base, at, path, place, source)
    along one path and one stretch of source."""
    along = Window.partitionBy("base").orderBy("at")
    same = F.lit(True)
    for column in ("place", "source"):
        same &= F.col(column) - F.lag(column).over(along) == 1
    same &= (F.col("at") - F.lag("at").over(along) == 1) & (F.col("path") == F.lag("path").over(along))
    marked = repeats.withColumn("new", (~F.coalesce(same, F.lit(False))).cast("int"))
    run = F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        marked.withColumn("run", run)
        .groupBy("base", "run")
        .agg(F.min("at").alias("at"), F.count("*").alias("n"), F.min("source").alias("source"))
        .select("base", (F.col("at") - F.col("base")).alias("start"), "n", "source")
    )


def blocks_of(spans: DataFrame, slots: DataFrame, length: int) -> DataFrame:
    """(base, start, n, source): words to be compared, at the spans and at their sources."""
    words = F.col("n") + (length - 1)
    cut = spans.withColumn("until", F.col("source") + words).select(
        "*", F.explode(F.expr(f"sequence(source div {BLOCK}, (until - 1) div {BLOCK})")).alias("block")
    )
    low = F.greatest("source", F.col("block") * BLOCK)
    high = F.least("until", (F.col("block") + 1) * BLOCK)
    there = cut.select(
        "base",
        (F.col("start") + low - F.col("source")).alias("start"),
        (high - low).alias("n"),
        low.alias("source"),
    )
    sources = there.select("n", "source", F.shiftright("source", SLOT_BITS).alias("slot")).distinct()
    here = sources.join(slots, "slot").select(
        "base", (F.col("source") - F.col("base")).alias("start"), "n", "source"
    )
    return there.union(here)


def numbered_texts(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(base, d1, d2, doc_id) of the first of each group of equal texts, and all documents
    (d1, d2, doc_id, copies). Coordinates rise with the order of documents."""
    rows = documents.select(
        "doc_id",
        F.xxhash64("text").alias("d1"),
        F.xxhash64(F.lit(1), "text").alias("d2"),
        F.length("text").alias("size"),
    )
    held = stored(rows.groupBy("doc_id", "d1", "d2", "size").agg(F.count("*").alias("copies")))
    first = held.groupBy("d1", "d2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "size")).alias("f")
    )
    ordered = first.select("f.*", "d1", "d2").orderBy("no_id", "doc_id", "d1", "d2")

    def run(incoming):
        before, part = 0, TaskContext.get().partitionId()
        for batch in incoming:
            slots = 1 + (batch.column("size").to_numpy().astype(np.int64) >> SLOT_BITS)
            ends = before + np.cumsum(slots)
            columns = [*(batch.column(c) for c in ("doc_id", "d1", "d2"))]
            made = [pa.array(np.full(len(ends), part), pa.int32()), pa.array(ends - slots), pa.array(slots)]
            yield pa.RecordBatch.from_arrays([*columns, *made], names=names)
            before = int(ends[-1]) if len(ends) else before

    names = ["doc_id", "d1", "d2", "part", "inside", "slots"]
    kind = documents.schema["doc_id"].dataType.simpleString()
    parts = stored(
        ordered.mapInArrow(run, f"doc_id {kind}, d1 long, d2 long, part int, inside long, slots long")
    )
    # One row for each shuffle partition that has rows.
    sums = parts.groupBy("part").agg(F.sum("slots").alias("slots")).orderBy("part").collect()
    offsets, before = [], 0
    for part, slots in sums:
        offsets.append((part, before))
        before += slots
    offset = documents.sparkSession.createDataFrame(offsets, "part int, offset long")
    slot = F.col("inside") + F.col("offset")
    placed = parts.join(F.broadcast(offset), "part").withColumn("slot", slot)
    base = F.shiftleft("slot", SLOT_BITS).alias("base")
    return stored(placed.select(base, "slot", "slots", "d1", "d2", "doc_id")), held


def _cleaned(texts: DataFrame, spans: DataFrame, blocks: DataFrame, length: int) -> DataFrame:
    """Texts with n_words, n_removed, kept and digests in place of base and text."""
    spot = [F.col(c).cast("int").alias(c) for c in ("start", "n")]
    removed = spans.select("base", F.struct(*spot).alias("span"), F.lit(None).alias("block"))
    compared = blocks.select("base", F.lit(None).alias("span"), F.struct(*spot, "source").alias("block"))
    wanted = (
        removed.unionByName(compared)
        .groupBy("base")
        .agg(F.collect_list("span").alias("spans"), F.collect_list("block").alias("blocks"))
    )
    found = "array<struct<source: long, n: int, digest: binary>>"
    kind = pa.list_(pa.struct([("source", pa.int64()), ("n", pa.int32()), ("digest", pa.binary())]))
    kept_columns = [c for c in texts.columns if c not in ("base", "text")]
    types = [f"{c} {texts.schema[c].dataType.simpleString()}" for c in kept_columns]
    schema = ", ".join([*types, f"n_words long, n_removed long, kept string, digests {found}"])
    names = [*kept_columns, "n_words", "n_removed", "kept", "digests"]

    def run(incoming):
        for whole in incoming:
            for batch in byte_slices(whole):
                *same, bodies, spans, blocks = batch.columns
                totals, lost, kept, digests = [], [], [], []
                rows = zip(bodies.cast(pa.binary()).to_pylist(), spans.to_pylist(), blocks.to_pylist())
                for text, removed, compared in rows:
                    words = text.split()
                    stays = np.ones(len(words), bool)
                    for span in removed or ():
                        stays[span["start"] : span["start"] + span["n"] + length - 1] = False
                    totals.append(len(words))
                    lost.append(len(words) - int(stays.sum()))
                    kept.append(b" ".join(compress(words, stays.tolist()) if lost[-1] else words))
                    parts = (
                        (b["source"], b["n"], b" ".join(words[b["start"] : b["start"] + b["n"]]))
                        for b in compared or ()
                    )
                    digests.append([(s, n, xxhash.xxh128_digest(part)) for s, n, part in parts])
                made = [
                    pa.array(totals, pa.int64()),
                    pa.array(lost, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(digests, kind),
                ]
                yield pa.RecordBatch.from_arrays([*same, *made], names=names)

    # Lists are small beside texts: hashing them spares a sort of the texts.
    joined = texts.join(wanted.hint("shuffle_hash"), "base", "left")
    return joined.select(*kept_columns, "text", "spans", "blocks").mapInArrow(run, schema)


def _attempt(texts: DataFrame, slots: DataFrame, hashes: Hashes) -> DataFrame | None:
    """The cleaned texts, or None if a span is not what its source says."""
    scratch = Scratch(texts.sparkSession)
    sieve = repeated_filter(texts, hashes)
    windows = edges(texts, hashes, sieve)
    counted = windows.groupBy("l", "r").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    graph = scratch.keep(counted.filter("n > 1").select("l", "r", "at"))
    paths = scratch.keep(compacted(graph, scratch)).withColumnRenamed("at", "source")
    repeats = scratch.keep(
        windows.join(paths, ["l", "r"])
        .filter("at != source")
        .select("base", "at", "path", "place", "source")
    )
    scratch.drop_all_but(1)
    spans = scratch.keep(spans_of(repeats))
    scratch.drop_all_but(1)
    blocks = scratch.keep(blocks_of(spans, slots, hashes.length))
    cleaned = scratch.keep(_cleaned(texts, spans, blocks, hashes.length))
    scratch.drop_all_but(1)
    compared = cleaned.select(F.explode("digests").alias("d")).groupBy("d.source", "d.n")
    odd = compared.agg(F.min("d.digest").alias("a"), F.max("d.digest").alias("b")).filter("a != b")
    return cleaned.drop("digests") if odd.isEmpty() else None


def without_repeats(documents: DataFrame, *, length: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every document (doc_id, text): its words, how
    many of them repeats cover, and the others with one space between them."""
    whole = documents.select("doc_id", whole_text().alias("text"))
    firsts, everyone = numbered_texts(whole)
    named = whole.withColumns({"d1": F.xxhash64("text"), "d2": F.xxhash64(F.lit(1), "text")})
    same = F.lit(True)
    for column in ("d1", "d2", "doc_id"):
        same &= F.col(f"w.{column}").eqNullSafe(F.col(f"f.{column}"))
    matched = named.alias("w").join(firsts.hint("shuffle_hash").alias("f"), same)
    matched = matched.select("f.base", "w.doc_id", "w.d1", "w.d2", "w.text")
    if not everyone.filter("copies > 1").isEmpty():
        matched = matched.dropDuplicates(["base"])
    scratch = Scratch(documents.sparkSession)
    texts = scratch.keep(matched)
    slots = firsts.select("base", F.explode(F.expr("sequence(slot, slot + slots - 1)")).alias("slot"))
    for seed in SEEDS:
        cleaned = _attempt(texts, slots, Hashes(seed, length))
        if cleaned is not None:
            break
    else:
        raise RuntimeError("spans differ from their sources under every seed")
    scratch.drop_all_but(0)
    # Every other row of a text is a repeat of the whole text, if that has a window.
    has_window = F.col("n_words") >= length
    known = cleaned.select(
        F.col("doc_id").alias("first_id"),
        "d1",
        "d2",
        "n_words",
        F.when(has_window, F.col("n_words")).otherwise(F.lit(0)).alias("n_removed"),
        F.when(has_window, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")).cast("int")
    again = everyone.join(known, ["d1", "d2"]).withColumn("copies", F.col("copies") - is_first)
    copies = again.select(
        "*", F.explode(F.expr("array_repeat(true, cast(copies as int))")).alias("there")
    )
    columns = ["doc_id", "n_words", "n_removed", "kept"]
    return cleaned.select(*columns).unionByName(copies.select(*columns))
