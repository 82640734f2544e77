"""Words and hashes of Arrow string columns, worked out on their UTF-8 bytes with numpy.

All separators used here are ASCII, so a byte below 0x80 decides by itself and every byte of a longer
code point is a word byte. Nothing is decoded, and a batch of a few MB takes a few dozen numpy calls.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240607)
#: A random 64-bit number for each byte; A-Z share those of a-z.
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_ODD = 0x9E3779B97F4A7C15
_ODD_INVERSE = pow(_ODD, -1, 2**64)
#: Bytes hashed at a time. It bounds the memory of a batch, whatever the length of a text.
PIECE = 1 << 20

#: Word bytes: all but the white space 0x20 and 0x09-0x0D.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Word bytes: digits, ASCII letters (A-Z count as a-z) and every code point from 0x80.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POW: dict[str, np.ndarray] = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW["up"]) < n:
        size = max(n, PIECE + 4096)
        _POW["up"], _POW["down"] = _powers(_ODD, size), _powers(_ODD_INVERSE, size)
    return _POW["up"], _POW["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offset of each row, one more at the end. Null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, kind, len(column) + 1 + column.offset)[column.offset :].astype(np.int64) if at is not None and len(column) else np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a batch: byte span of each, and for each row the number of its first word, one more at the end."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def words(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> Words:
    """Maximal runs of word bytes; a run ends with its row."""
    inside = is_word[raw]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(raw))]
    starts[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    start = np.flatnonzero(starts)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def hashes(raw: np.ndarray, w: Words, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each word; with ``fold``, A-Z hash as a-z. Works through pieces that end with a word."""
    table = _FOLDED if fold else _BYTE
    out = np.empty(len(w.start), np.uint64)
    i = 0
    while i < len(out):
        base = w.start[i]
        j = max(i + 1, int(np.searchsorted(w.end, base + PIECE, "right")))
        size = int(w.end[j - 1] - base)
        up, down = _pow(size + 1)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(table[raw[base : base + size]] * up[:size], out=total[1:])
        s, e = w.start[i:j] - base, w.end[i:j] - base
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``k`` consecutive words of each row, sorted in each row, and offsets of the rows.

    A row of fewer words, but not none, has its whole sequence as its one shingle.
    """
    n = np.diff(first)
    size = np.maximum(n - k + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), size)
    begin = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(len(row))
    length = np.minimum(n, k)[row]
    key = np.zeros(len(row), np.uint64)
    for i in range(k):
        on = length > i
        key[on] = key[on] * np.uint64(_ODD) + h[begin[on] + i]
    key = mix(key + length.astype(np.uint64))
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    key, row = key[fresh], row[fresh]
    return key, np.searchsorted(row, np.arange(len(n) + 1))


def slices(batch: pa.RecordBatch, text: int, most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``most`` bytes of text each (a longer row stands alone)."""
    _, offsets = buffers(batch.column(text))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield batch.slice(i, min(j, n) - i)
        i = min(j, n)
