"""Cutting texts into pieces that a byte-pair tokenizer encodes independently, and a worker's cache of their ids.

Pieces are runs without ASCII white space. For the byte-level family a piece takes the one space before it along,
and what is left of a run of white space is a piece too: the split pattern ``\\s+(?!\\S)|\\s+`` gives the last character
of a run to the word only if it is a space. A row in which this may not hold (other Unicode white space, or a special
string) is handed to the library whole. Each piece is encoded by the library itself.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable

import numpy as np

from .arrowtext import NOT_SPACE, Words, hashes, words

#: Entries of a generation of a worker's cache; two generations are held at most.
CACHE_ENTRIES = 400_000
#: Bare words whose ids are held while the same word stands with different marks.
KNOWN_WORDS = 200_000


def tokenizer_of(definition: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(definition)
    t.no_truncation()
    t.no_padding()
    return t


def special_strings(definition: str) -> list[bytes]:
    import json

    return [x["content"].encode() for x in json.loads(definition).get("added_tokens") or []]


def odd_rows(raw: np.ndarray, offsets: np.ndarray, strings: list[bytes], spaces: bool = True) -> np.ndarray:
    """Rows that hold one of ``strings`` or, with ``spaces``, white space beyond ASCII."""
    at = []
    data = raw.tobytes() if strings else b""
    for s in strings:
        i = data.find(s)
        while i >= 0:
            at.append(i)
            i = data.find(s, i + 1)
    found = [np.array(at, np.int64)]
    if spaces and len(raw):
        pad = np.concatenate([raw, np.zeros(2, np.uint8)])
        two, three = pad[1:-1], pad[2:]
        found.append(np.flatnonzero((raw == 0xC2) & ((two == 0x85) | (two == 0xA0))))
        lead = np.flatnonzero((raw >= 0xE1) & (raw <= 0xE3))
        a, b, c = raw[lead], two[lead], three[lead]
        wide = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        found.append(lead[wide])
        found.append(np.flatnonzero((raw >= 0x1C) & (raw <= 0x1F)))
    where = np.concatenate(found)
    return np.unique(np.searchsorted(offsets, where, "right") - 1)


def byte_level_pieces(raw: np.ndarray, offsets: np.ndarray) -> Words:
    """Pieces for byte-level tokenizers: every byte is in one piece."""
    w = words(raw, offsets, NOT_SPACE)
    n = len(raw)
    begin = w.start.copy()
    row_start = np.zeros(n + 1, bool)
    row_start[offsets] = True
    room = np.flatnonzero((begin > 0) & ~row_start[begin])
    takes = room[raw[begin[room] - 1] == 0x20]
    begin[takes] -= 1
    # what lies between pieces, cut at the ends of rows; a last character that no word takes stands alone
    lone = np.setdiff1d(room, takes, assume_unique=True)
    cuts = np.sort(np.concatenate([offsets, begin, w.end, w.start[lone] - 1]), kind="stable")
    cuts = cuts[np.concatenate([[True], cuts[1:] != cuts[:-1]])]
    start, end = cuts[:-1], cuts[1:]
    return Words(start, end, np.searchsorted(start, offsets))


#: A word of Latin letters that need no normalising, then ASCII marks but apostrophes: two pre-tokens of either family.
PLAIN = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-&(-/:-@\\[-`{-~]*)")


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class PieceEncoder:
    """Token ids of pieces, as little-endian 4-byte numbers. Plain words go to the library's model directly, all others through the whole library."""

    def __init__(self, definition: str, fold: bool):
        self.tokenizer, self.fold = tokenizer_of(definition), fold
        self.model, self.letters, self.known = self.tokenizer.model, byte_letters(), {}

    def word(self, text: str) -> bytes:
        if self.fold:
            text = text.lower()
        found = self.known.get(text)
        if found is None:
            # printable ASCII stands for itself in a byte-level vocabulary
            shown = text.replace(" ", self.letters[0x20]) if text.isascii() else "".join(map(self.letters.__getitem__, text.encode()))
            found = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            self.known[text] = found
        return found

    def __call__(self, pieces: list[str]) -> list[bytes]:
        out: list = [None] * len(pieces)
        rest = []
        for i, p in enumerate(pieces):
            if m := PLAIN.fullmatch(p):
                word, marks = m.groups()
                out[i] = self.word(word) + self.word(marks) if marks else self.word(word)
            else:
                rest.append(i)
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = array("I", e.ids).tobytes()
        return out


class PieceCache:
    """What the library gives for a piece, for the pieces seen of late. It survives from task to task."""

    def __init__(self, encode: Callable[[list[str]], list], entries: int = CACHE_ENTRIES):
        self.encode, self.entries, self.young, self.old = encode, entries, {}, {}

    def get(self, pieces: list[bytes]) -> list:
        young, old, missing = self.young, self.old, []
        out = [young.get(p) for p in pieces]
        for i, x in enumerate(out):
            if x is None:
                x = old.get(pieces[i])
                if x is None:
                    missing.append(i)
                else:
                    out[i] = young[pieces[i]] = x
        if missing:
            for i, x in zip(missing, self.encode([pieces[i].decode() for i in missing]), strict=True):
                out[i] = x
                if len(pieces[i]) <= 64:
                    young[pieces[i]] = x
        if len(young) > self.entries:
            self.old, self.young = young, {}
        return out


def distinct(raw: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """The first occurrence of each different piece, and for each piece its place among these."""
    h = hashes(raw, w, fold=False)
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    return first, inverse
