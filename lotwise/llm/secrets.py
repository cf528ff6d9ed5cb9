"""Secrets in texts: fixed patterns, and values that would be hard to guess.

The patterns find assignments of credentials, access keys and long hexadecimal
runs. Beyond them, values that stand in the context of a credential are cut into
words, dates, repeats, keyboard walks and brute-force spans so that guessing them
in this order costs least; a value that still costs ``MIN_GUESSES`` is a secret. Every
such value is scored, also one that a pattern covers; its span stands beside the other.

Null and empty texts hold no secrets. Rows are kept one to one with all their
columns. Positions are code points, the end exclusive.
"""

from __future__ import annotations

import functools
import json
import re
from math import log10

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The patterns and what their matches need. A match that falls
# short is dropped; the search goes on behind it.
KINDS = ["assign", "access", "hex", "guess"]
ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
ASSIGN_VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ["password", "passwd", "secret", "token", "apikey", "api_key"]

# Contexts that announce a credential, and the shortest value worth a look. A name
# may carry a suffix, as in secret_access_key. Each form is listed with a lower-case
# stem that stands in all its matches; without any stem in a text, none is looked for.
CONTEXT_FORMS = {
    "pass": r"pass(?:word|wd|phrase|code)",
    "pwd": r"pwd",
    "secret": r"secret",
    "token": r"token",
    "api": r"api[_ -]?key",
    "credential": r"credentials?",
    "private": r"private[_ -]key",
    "auth": r"auth(?:orization)?",
}
CONTEXT_SUFFIX = (
    r"(?:[_ -](?:access|api|auth|client|encryption|master|private|secret|shared|signing)){0,3}"
    r"[_ -](?:key|token|secret|value|password)"
)
CONTEXT = re.compile(
    rf"(?i:(?<![a-z])(?:{'|'.join(CONTEXT_FORMS.values())})(?:{CONTEXT_SUFFIX})?)"
    r"[\"']?\x20*(?::=|=>|[:=]|\x20is\x20)\x20*[\"']?([^\s\"'<>(),;]{8,})",
    re.ASCII,
)

# A value is a secret if guessing it takes ten to this power of guesses.
MIN_GUESSES = 10.0

# What stands in the place of a secret.
MASK = "[SECRET]"

# The rows of a keyboard, unshifted and shifted.
KEYBOARD = ["`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./"]
SHIFTED = ["~!@#$%^&*()_+", "QWERTYUIOP{}|", 'ASDFGHJKL:"', "ZXCVBNM<>?"]
KEYS = 47
DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d"
    r"|(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\3(?:19|20)\d\d"
    r"|(?:19|20)\d\d"
)
DATE_COST = log10(365 * 120)
YEAR_COST = log10(120)

# Shortest pieces that count, longest word, and longest unit of a repeat.
LEAST_WALK = 3
LEAST_WORD = 3
LONGEST_WORD = 20
LONGEST_UNIT = 8
# What one more piece costs: a guesser must also guess where pieces meet.
PIECE_COST = log10(2)


@functools.lru_cache(maxsize=2)
def ranked_words(vocabulary_path: str | None) -> dict[str, float]:
    """Cost of each word: its place among the words of a tokenizer's vocabulary,
    which lists what is frequent first."""
    words: dict[str, float] = {}
    if vocabulary_path:
        with open(vocabulary_path, encoding="utf-8") as file:
            ids = json.load(file)["model"]["vocab"]
        for token in sorted(ids, key=ids.get):
            word = token.lstrip("Ġ").lower()
            if LEAST_WORD <= len(word) <= LONGEST_WORD and word.isascii() and word.isalpha():
                words.setdefault(word, log10(1 + len(words)))
    return words


@functools.lru_cache(maxsize=1)
def keyboard_neighbours() -> dict[str, set[str]]:
    place = {}
    for rows in (KEYBOARD, SHIFTED):
        for y, row in enumerate(rows):
            for x, key in enumerate(row):
                place[key] = (x, y)
    return {
        a: {
            b
            for b, (u, v) in place.items()
            if (u, v) != (x, y) and abs(v - y) <= 1 and abs(u - x) <= 1
        }
        for a, (x, y) in place.items()
    }


def _character_cost(c: str) -> float:
    if not c.isascii():
        return 2.0
    return log10(10 if c.isdigit() else 26 if c.isalpha() else 33)


def guess_cost(value: str, words: dict[str, float]) -> float:
    """Power of ten of the guesses that the cheapest cut of a value needs.

    Linear in the value's length: of each walk and each repeat, only the longest
    from its start is tried, and words have a greatest length.
    """
    size = len(value)
    low = value.lower()
    near = keyboard_neighbours()
    dates = {}
    for start in range(size):
        if value[start].isdigit() and (found := DATE.match(value, start)):
            dates[start] = (found.end(), YEAR_COST if found.end() - start == 4 else DATE_COST)

    # How far a walk, or a repeat of a unit of each length, goes on from a place.
    walk = [1] * (size + 1)
    turn = [0] * (size + 1)
    for i in range(size - 2, -1, -1):
        if value[i + 1] in near.get(value[i], ()):
            walk[i] = walk[i + 1] + 1
            straight = walk[i + 1] > 1 and _step(value, i) == _step(value, i + 1)
            turn[i] = turn[i + 1] + (0 if straight else 1)
    same = {}
    for unit in range(1, min(LONGEST_UNIT, size // 2) + 1):
        run = [0] * (size + 1)
        for i in range(size - unit - 1, -1, -1):
            if value[i] == value[i + unit]:
                run[i] = run[i + 1] + 1
        same[unit] = run

    cost = [0.0] + [float("inf")] * size
    forced = [False] * (size + 1)

    def reach(start: int, end: int, more: float, brute: bool = False) -> None:
        joins = start > 0 and not (brute and forced[start])
        total = cost[start] + more + (PIECE_COST if joins else 0.0)
        if total < cost[end]:
            cost[end], forced[end] = total, brute

    for i in range(size):
        reach(i, i + 1, _character_cost(value[i]), brute=True)
        if i in dates:
            reach(i, *dates[i])
        if walk[i] >= LEAST_WALK:
            reach(i, i + walk[i], log10(KEYS * walk[i]) + 0.6 * turn[i])
        for unit, run in same.items():
            if run[i] >= unit and run[i] + unit >= LEAST_WALK:
                times = (run[i] + unit) // unit
                brute = sum(map(_character_cost, value[i : i + unit]))
                once = min(brute, words.get(low[i : i + unit], brute))
                reach(i, i + times * unit, once + log10(times))
        for end in range(i + LEAST_WORD, min(size, i + LONGEST_WORD) + 1):
            rank = words.get(low[i:end])
            if rank is not None:
                part = value[i:end]
                capitals = 0.0 if part == low[i:end] else 0.3 if part.istitle() else 0.6
                reach(i, end, rank + capitals)
    return cost[size]


def _step(value: str, i: int) -> tuple[int, int]:
    for rows in (KEYBOARD, SHIFTED):
        for y, row in enumerate(rows):
            if value[i] in row:
                for other in (KEYBOARD, SHIFTED):
                    for v, keys in enumerate(other):
                        if value[i + 1] in keys:
                            return keys.index(value[i + 1]) - row.index(value[i]), v - y
    return 0, 0


def find(text: str, words: dict[str, float], min_guesses: float = MIN_GUESSES) -> list[tuple]:
    """(kind, start, end) of each secret, by start, then kind in the order of KINDS."""
    spans = [("hex", *m.span()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    low = text.lower()
    if any(name in low for name in NAMES):
        spans += [
            ("assign", *m.span())
            for m in ASSIGN.finditer(text)
            if len(m.group(2)) >= ASSIGN_VALUE
        ]
    if any(stem in low for stem in CONTEXT_FORMS):
        spans += [
            ("guess", *m.span(1))
            for m in CONTEXT.finditer(text)
            if guess_cost(m.group(1), words) >= min_guesses
        ]
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0])))


def masked(text: str, spans: list[tuple], mask: str = MASK) -> str:
    """The text with every span replaced by a mask; spans that overlap become one."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
)
ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


def find_secrets(
    documents: DataFrame,
    *,
    text: str = "text",
    into: str = "secrets",
    masked_into: str | None = None,
    words_path: str | None = None,
    min_guesses: float = MIN_GUESSES,
) -> DataFrame:
    """Add an array of (kind, start, end) to each document; under ``masked_into``, if
    named, also the text with a mask in place of each (null stays null)."""
    new = {into: SPANS} | ({masked_into: T.StringType()} if masked_into else {})
    taken = {name.lower() for name in new}
    kept = [name for name in documents.columns if name.lower() not in taken]
    place = kept.index(text)

    def run(incoming):
        words = ranked_words(words_path)
        for batch in incoming:
            found, clean = [], []
            for value in batch.column(place):
                content = value.as_py()
                spans = find(content or "", words, min_guesses)
                found.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
                if masked_into:
                    clean.append(masked(content, spans) if spans else content)
            made = [pa.array(found, ARROW_SPANS)]
            if masked_into:
                made.append(pa.array(clean, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*kept, *new])

    frame = documents.select(*kept)
    fields = [T.StructField(name, kind) for name, kind in new.items()]
    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, *fields]))


def spelled(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )
