"""Cutting text where a byte-level tokenizer cuts it, and remembering the pieces.

A byte-level BPE never merges over the borders its pattern draws, so a piece of
text has the same ids wherever it stands. Text is cut at single spaces first:
such a space always opens a new piece. Texts with other runs of white space
take the pattern itself.
"""

from __future__ import annotations

from collections.abc import Callable

import regex

# White space as the tokenizer's pattern understands it, and that pattern.
SPACE = r"\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
LOOSE_SPACE = regex.compile(rf" (?:[{SPACE}]|\Z)")

# Signs that follow a word; together they are one piece.
SIGNS = ".,;:!?"

# Pieces longer than this are not remembered. A memory holds so many pieces in two
# halves; when the newer is full, the older is given up.
LONGEST_KEPT = 64
KEPT_PIECES = 120_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabulary files.

    Printable Latin-1 bytes stand for themselves, the others for the letters
    from code point 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class PieceMemory(dict):
    """Ids of pieces, computed when a piece is first met. Pieces that keep coming back
    move from the older half to the newer, so they stay remembered."""

    def __init__(self, encode_piece: Callable[[str], bytes], room: int = KEPT_PIECES):
        super().__init__()
        self.encode_piece = encode_piece
        self.half = max(1, room // 2)
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode_piece(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class TextEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit integers.

    ``encode_piece`` encodes one piece of text as the pattern cuts it. A word with
    signs around it is put together from its pieces, so that a word is encoded once
    however it is punctuated. ``special`` maps the strings of special tokens to ids;
    the leftmost, then longest, one wins.
    """

    def __init__(
        self,
        encode_piece: Callable[[str], bytes],
        special: dict[str, int],
        room: int = KEPT_PIECES,
    ):
        self.encode_piece = encode_piece
        self.first = PieceMemory(self._run)
        self.after_space = PieceMemory(lambda run: self._run(" " + run), room)
        self.special = {text: i.to_bytes(4, "little") for text, i in special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, longest_first))) if special else None

    def _run(self, run: str) -> bytes:
        """Most runs are a word, or a word and signs; those need no pattern."""
        word = run[1:] if run[0] == " " else run
        if word.isalpha():
            return self.encode_piece(run)
        head = word.rstrip(SIGNS)
        if head.isalpha():
            known = self.first if word is run else self.after_space
            return known[head] + self.first[word[len(head) :]]
        pieces = PATTERN.findall(run)
        if len(pieces) == 1:
            return self.encode_piece(run)
        return b"".join(
            self.after_space[p[1:]] if p[0] == " " and len(p) > 1 else self.first[p] for p in pieces
        )

    def __call__(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return self._plain(text)
        out, at = [], 0
        for found in self.cut.finditer(text):
            out += [self._plain(text[at : found.start()]), self.special[found.group()]]
            at = found.end()
        return b"".join([*out, self._plain(text[at:])])

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        if LOOSE_SPACE.search(text):
            return b"".join(map(self.first.__getitem__, PATTERN.findall(text)))
        head, *rest = text.split(" ")
        parts = map(self.after_space.__getitem__, rest)
        return b"".join([self.first[head] if head else b"", *parts])
