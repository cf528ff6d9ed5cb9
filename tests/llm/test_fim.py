from __future__ import annotations

import hashlib
import random
import re

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from lotwise.llm import fim, queries

UNITS = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain(doc_id, text):
    """The contract once more, with a list of units."""
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


LONG = ["ab " * 60_000, "word" * 50_000, "1" * 65_536, "a" * 65_535 + "1", "a1" * 70_000]


@pytest.mark.parametrize("number", range(len(LONG) + 20))
def test_select_equals_a_list_of_offsets(number):
    draw = random.Random(number)
    alphabet = draw.choice(["ab ", "a1é😀", "@[`{zZaA\n"])
    mixed = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 150_000 if number % 5 else 40)))
    text = LONG[number] if number < len(LONG) else mixed
    offsets = [0]
    for unit in UNITS.findall(text):
        offsets.append(offsets[-1] + len(unit))
    found = fim.boundaries(text)
    assert len(found) == len(offsets)
    for place in {0, len(offsets) - 1, *(draw.randrange(len(offsets)) for _ in range(300))}:
        assert found.select(place) == offsets[place]
    for place in (-1, len(offsets)):
        with pytest.raises(IndexError):
            found.select(place)


def test_each_kind_of_container_is_used():
    kinds = set()
    for text in [*LONG, "a few words", "1 2 3 4 " * 200]:
        kinds |= {type(c) for c in fim.boundaries(text).containers}
    assert kinds == {fim.ArrayContainer, fim.BitmapContainer, fim.RunContainer}


def test_query_equals_a_plain_loop(spark):
    texts = dict(rows(spark.read.parquet(f"{SMALL}/documents.parquet"), "doc_id", "text"))
    found = queries.op13_fim(spark, SMALL).collect()
    assert len(found) == len(texts)
    for row in found:
        n, form, prefix, middle, output = plain(row.doc_id, texts[row.doc_id])
        assert tuple(row) == (row.doc_id, n, form, prefix, middle, sha(output), sha(texts[row.doc_id]))
    assert {r.form for r in found} == {"plain", "psm", "spm"}


ODD = [
    (1, None),
    (2, ""),
    (3, "<P> is here"),
    (4, "<P <S <M"),
    (5, "<P<S>"),
    (None, "no id at all"),
    (None, None),
    (7, "twice the same"),
    (7, "twice the same"),
    (8, "ends in a mark's head <"),
    (9, "P>S>M> tails"),
    (10, "é \x00 \r\n😀"),
    *((i, "<" * (i % 7) + "P>" * (i % 3) + f" text {i} ") for i in range(100, 200)),
    (11, "very long " * 100_000),
]


def test_odd_rows_and_clashing_columns(spark):
    frame = spark.createDataFrame(
        [(i, t, "kept", "gone", 0) for i, t in ODD],
        "doc_id long, text string, extra string, Output string, N int",
    )
    made = fim.fill_in_middle(frame)
    assert made.columns == ["doc_id", "extra", *fim.MADE]
    found = rows(made.withColumn("back", fim.restored()))
    wanted = [(i, "kept", *plain(i, t), t or "") for i, t in ODD]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert fim.fill_in_middle(frame).select(F.count("*")).first()[0] == 0
