"""Fast similarity sketching of sets of 64-bit hashes (Dahlgaard, Knudsen, Thorup 2017), for many sets at a time.

A sketch has ``t`` coordinates. In round ``i`` of the first ``t`` rounds every element is thrown into one
random bin with the value ``i + fraction``; in rounds ``t`` to ``2t - 1`` round ``t + j`` throws all elements
into bin ``j``, so each coordinate is filled after ``2t`` rounds at most. A coordinate keeps its least value.
Two sets agree in a coordinate with the probability of their Jaccard similarity, and the number of agreeing
coordinates is concentrated as if elements were drawn without replacement. A set stops when its bins are full,
so large sets take one or two rounds in place of ``t`` hash functions.
"""

from __future__ import annotations

import numpy as np

from .arrowtext import mix


def sketch(keys: np.ndarray, offsets: np.ndarray, t: int, seed: int = 7) -> np.ndarray:
    """Sketches, one row of ``t`` 64-bit values for each set ``keys[offsets[i]:offsets[i + 1]]``; empty sets have zeros."""
    n = len(offsets) - 1
    out = np.full((n, t), np.iinfo(np.uint64).max, np.uint64)
    open_sets = np.flatnonzero(np.diff(offsets) > 0)
    sizes = np.diff(offsets)
    for i in range(2 * t):
        if not len(open_sets):
            break
        size = sizes[open_sets]
        row = np.repeat(open_sets, size)
        first = np.cumsum(size) - size
        at = np.repeat(offsets[open_sets] - first, size) + np.arange(len(row))
        h = mix(keys[at] ^ mix(np.array([seed * 1_000_003 + i + 1], np.uint64)))
        # the round comes first, then the fraction
        value = (np.uint64(i) << np.uint64(52)) | (h & np.uint64((1 << 52) - 1))
        column = ((h >> np.uint64(52)) * np.uint64(t) >> np.uint64(12)).astype(np.int64) if i < t else np.full(len(row), i - t)
        cell = row * t + column
        order = np.lexsort((value, cell))
        cell = cell[order]
        least = np.ones(len(cell), bool)
        least[1:] = cell[1:] != cell[:-1]
        flat = out.reshape(-1)
        cell = cell[least]
        flat[cell] = np.minimum(flat[cell], value[order][least])
        open_sets = open_sets[(out[open_sets] == np.iinfo(np.uint64).max).any(axis=1)]
    out[sizes == 0] = 0
    return out


def bands_for(similarity: float, rows: int, miss: float) -> int:
    """Bands of ``rows`` coordinates after which a pair just at ``similarity`` shares no band with probability ``miss`` at most."""
    return int(np.ceil(np.log(miss) / np.log1p(-(similarity**rows))))


def band_keys(sketches: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of ``rows`` coordinates; the number of the band is part of it."""
    n, t = sketches.shape
    bands = t // rows
    key = np.zeros((n, bands), np.uint64)
    for r in range(rows):
        key = mix(key * np.uint64(31) + sketches[:, r : bands * rows : rows])
    return mix(key + np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15))
