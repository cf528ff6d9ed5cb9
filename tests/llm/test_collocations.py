from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import pytest
from conftest import SMALL, rows

from lotwise.llm import collocations, queries


def plain_counts(documents, longest):
    """All phrases of each language, by a plain loop."""
    counts = Counter()
    for _, text, lang in documents:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts[lang or "und", 0, ""] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang or "und", size, " ".join(words[i : i + size])] += 1
    return counts


def plain_candidates(documents, least, longest, percent):
    counts = plain_counts(documents, longest)
    best = {}
    for (lang, size, phrase), a in counts.items():
        if size < 2 or a < least:
            continue
        words = phrase.split(" ")
        cuts = []
        for k in range(1, size):
            l = counts[lang, k, " ".join(words[:k])]
            r = counts[lang, size - k, " ".join(words[k:])]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        best[lang, phrase] = (size, a, l, r, counts[lang, 0, ""], score)
    return {
        (lang, phrase, *made)
        for (lang, phrase), made in best.items()
        if not any(
            other == lang and f" {phrase} " in f" {longer} " and longer != phrase
            and 100 * best[other, longer][1] >= percent * made[1]
            for other, longer in best
        )
    }


def some_documents(seed, n=400):
    """Few words, so that phrases repeat, with all that separates words and pieces."""
    draw = random.Random(seed)
    words = ["a", "B", "cc", "dé", "e\x00f", "  ", "\t", "g.", "h\n", "i,j", "K", "l\x0b", " m"]
    weights = [9, 8, 7, 6, 1, 2, 2, 2, 1, 1, 3, 1, 1]
    made = []
    for i in range(n):
        text = " ".join(draw.choices(words, weights, k=draw.randint(0, 30)))
        made.append((i, text, draw.choice(["en", "en", "fr", None])))
    return made


def frame_of(spark, documents):
    return spark.createDataFrame(documents, "doc_id long, text string, lang string").repartition(3)


@pytest.mark.parametrize("percent, lowered", [(10, 0.6), (1, 3.0), (100, 1.0), (0, 1.0), (10, 50.0)])
def test_any_sample_gives_the_same_phrases(spark, percent, lowered):
    """A sample that proposes too little, or nothing, costs passes and no phrase."""
    documents = some_documents(3)
    counts = plain_counts(documents, 4)
    found, passes = collocations.frequent_phrases(
        frame_of(spark, documents), least=12, sample_percent=percent, lowered=lowered
    )
    expected = {(*key, n) for key, n in counts.items() if n >= 12 or key[1] == 0}
    listed = rows(found, "lang", "size", "phrase", "n")
    assert len(listed) == len(set(listed)) and set(listed) == expected
    assert passes == (1 if percent == 100 else 2)


def test_filters_too_small_change_no_count(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FILTER_BYTES", 8)
    documents = some_documents(4)
    found, _ = collocations.frequent_phrases(frame_of(spark, documents), least=12)
    expected = {(*key, n) for key, n in plain_counts(documents, 4).items() if n >= 12 or key[1] == 0}
    assert set(rows(found, "lang", "size", "phrase", "n")) == expected


def test_chunks_change_no_count(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 1)
    documents = some_documents(5, 60)
    found, _ = collocations.frequent_phrases(frame_of(spark, documents), least=5)
    expected = {(*key, n) for key, n in plain_counts(documents, 4).items() if n >= 5 or key[1] == 0}
    assert set(rows(found, "lang", "size", "phrase", "n")) == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_candidates_equal_a_plain_loop(spark, seed):
    documents = [
        *some_documents(seed),
        (None, "A b cc " * 40, "en"),
        (7, "a B CC " * 40, "en"),
        (7, "a B CC " * 40, "en"),
        (8, None, "en"),
        (9, "", None),
        (10, ".,;:!?", "xx"),
        (11, "one line that repeats. " * 5000, "de"),
    ]
    frame = frame_of(spark, documents).selectExpr("*", "1 as n", "2 as size", "'x' as phrase")
    found = rows(collocations.collocations(frame, least=12), "lang", "phrase", "size", "a", "l", "r", "n", "score")
    assert len(found) == len(set(found))
    assert set(found) == plain_candidates(documents, 12, 4, 80)


def test_empty_table(spark):
    assert collocations.collocations(frame_of(spark, []), least=2).count() == 0


def test_query_equals_sql(spark):
    database = duckdb.connect()
    database.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    result = database.execute(queries.ORACLES["op12_collocations"])
    names = [column[0] for column in result.description]
    found = rows(queries.op12_collocations(spark, SMALL), *names)
    assert sorted(found) == sorted(result.fetchall()) and found
