from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from conftest import SMALL, rows

from lotwise.llm import queries, repeats


def plain(documents, length):
    """(doc_id, n_words, n_removed, kept), by a table of all windows."""
    key = lambda row: (row[0] is None, row[0] or 0)
    # Of rows with one id and one text it does not matter which is first.
    ordered = sorted(documents, key=key)
    seen, made = set(), []
    for doc_id, text in ordered:
        words = (text or "").translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ")
        words = [w for w in words if w]
        lost = [False] * len(words)
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            if window in seen:
                lost[i : i + length] = [True] * length
            seen.add(window)
        kept = " ".join(w for w, gone in zip(words, lost) if not gone)
        made.append((doc_id, len(words), sum(lost), kept))
    return made


def compared(spark, documents, length):
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    frame = frame.selectExpr("*", "1 as base", "'x' as d1", "2 as n_words").repartition(3)
    found = rows(repeats.without_repeats(frame, length=length))
    assert sorted(found, key=repr) == sorted(plain(documents, length), key=repr)
    return found


def passages(seed, n, vocabulary, longest=60):
    """Texts put together from a few passages and loose words."""
    draw = random.Random(seed)
    word = lambda: draw.choice(vocabulary)
    stock = [[word() for _ in range(draw.randint(3, 40))] for _ in range(12)]
    made = []
    for i in range(n):
        words = []
        while len(words) < draw.randint(0, longest):
            words += draw.choice(stock) if draw.random() < 0.5 else [word() for _ in range(5)]
        made.append((i * 3 % n, draw.choice([" ", "  ", "\n", "\t"]).join(words)))
    return made


@pytest.mark.parametrize(
    "seed, vocabulary, length",
    [(1, [f"w{i}" for i in range(500)], 20), (2, ["a", "b"], 5), (3, ["a", "b", "c"], 3), (4, ["x"], 4), (5, ["a", "b"], 2)],
)
def test_equals_a_table_of_windows(spark, seed, vocabulary, length):
    """Few words give cycles, branches and windows that overlap themselves."""
    found = compared(spark, passages(seed, 80, vocabulary), length)
    assert any(row[2] for row in found) and any(row[3] for row in found)


def test_odd_rows(spark):
    line = " ".join(f"w{i}" for i in range(30))
    other = " ".join(f"v{i}" for i in range(25))
    documents = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, line),
        (4, line),
        (4, f"{other} {line}"),
        (None, line),
        (None, line),
        (None, f"{other} tail"),
        (5, "short text"),
        (5, "short text"),
        (6, "short text"),
        (7, f"head {other} {line} {line}"),
        (8, "n\u00a0b\u2003s é\x00 " + line[:60]),
        (9, "again " * 100),
        (10, "x" * 1000 + " " + line),
        (11, "y" * 300_000 + " " + line + " " + "z" * 300_000),
    ]
    compared(spark, documents, 20)


def test_a_text_of_several_slots(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SLOT_BITS", 5)
    draw = random.Random(7)
    documents = passages(6, 20, [f"w{i}" for i in range(300)])
    long = " ".join(f"w{draw.randrange(300)}" for _ in range(500))
    documents += [(100, long), (101, f"{documents[3][1]} {long} end"), (102, long[50:2000])]
    compared(spark, documents, 6)


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.without_repeats(frame, length=20).count() == 0


def test_a_filter_too_small_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(repeats, "FILTER_BYTES", 8)
    compared(spark, passages(8, 40, [f"w{i}" for i in range(200)]), 8)


def test_spans_that_differ_from_their_source_are_not_taken(spark, monkeypatch):
    """Nodes that mean nothing: every attempt is refused."""
    made = repeats.Hashes.__init__

    def blind(self, seed, length):
        made(self, seed, length)
        self.factors[0] = 0

    monkeypatch.setattr(repeats.Hashes, "__init__", blind)
    monkeypatch.setattr(repeats, "SEEDS", range(1, 3))
    documents = passages(9, 10, [f"w{i}" for i in range(100)])
    with pytest.raises(RuntimeError, match="every seed"):
        compared(spark, documents, 4)


def test_words_hash_alike_wherever_they_stand():
    draw = random.Random(2)
    hashes = repeats.Hashes(1, 20)
    known = {}
    for turn in range(100):
        signs = ["a", "b", " ", "\n", "é", "x" * draw.randint(1, 400)]
        texts = ["".join(draw.choices(signs, k=draw.randint(0, 60))).encode() for _ in range(3)]
        if turn % 50 == 0:
            texts.append(b"y" * 600_000 + b" z " + b"w" * repeats.PIECE_BYTES)
        found, ends = hashes.words(texts)
        words = [text.split() for text in texts]
        assert ends.tolist() == np.cumsum([len(w) for w in words]).tolist()
        for word, value in zip((w for some in words for w in some), found.tolist()):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


def test_paths_and_cycles(spark):
    chain = [(i, i - 1, 2) for i in range(1, 40)]
    cycle = [(100, 102, 1), (101, 100, 1), (102, 101, 1), (200, 200, 1)]
    pointers = spark.createDataFrame([*chain, *cycle], "piece long, up long, far long")
    assert sorted(rows(repeats.path_roots(pointers))) == [(i, 0, 2 * i) for i in range(1, 40)]
    assert repeats.path_roots(pointers.filter("false")).count() == 0


def test_query_equals_a_table_of_windows(spark):
    texts = rows(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id", "text")
    expected = {
        (i, n, lost, hashlib.sha256(kept.encode()).hexdigest()) for i, n, lost, kept in plain(texts, 20)
    }
    assert set(rows(queries.op11_repeats(spark, SMALL))) == expected
