"""Byte-pair encoding and decoding with contiguous rank arrays.

A word is held as the ids of its parts and, beside them, the ranks of the pairs of neighbouring parts. The array of ranks is
scanned for its least entry (the first of equals), the boundary there is deleted, and the ranks of the two pairs that touch the
new part are looked up again; until no pair has a rank. Words of the same length are done together, one row of a matrix each:
every merge takes one boundary from every row that still merges, so rows stay contiguous and no word has padding. Words of
more than ``SHORT`` bytes would be scanned too often; they keep their ranks in a heap, with the same result.

Texts are cut at ASCII white space, where words of both families of definitions end; what an equal piece has given is
kept in a bounded cache of the worker. The parts of a piece that are no plain words are normalised and cut by the definition's
own rules (through the library's normaliser and pre-tokeniser), so that cases of Unicode are the library's. Rows are
encoded and decoded where they are read: nothing is shuffled.

Definitions: byte-level BPE in the tokenizers library's .json form, with or without an end-of-word suffix. Decoding follows the
definition's decoder: byte-level (bytes joined, undecodable ones replaced) or none (the entries joined by one space).

Defined results
* null is an empty text: no ids, and decoded to an empty text. Null ids decode to an empty text too.
* strings of the definition's added tokens become their ids, as the library does by default; nothing else is added.
* ids that no entry has are passed over in decoding, as in the library.
* every row gives a row, whatever it repeats; an empty table gives an empty table; other columns are kept, but for those with
  the name of a result. Very long texts are rows like others; a very long word takes n log n time.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .arrowtext import NOT_SPACE, buffers, slices, words
from .pretokens import PLAIN, PieceCache, byte_letters, byte_level_pieces, distinct, odd_rows, special_strings, tokenizer_of
from .shared import checked, tidy

#: Bytes of a word whose ranks are scanned; longer words use a heap.
SHORT = 48
#: Words of one length merged at a time, and bytes of text whose pieces are looked up at a time.
ROWS, TEXT = 8192, 2 << 20
#: Entries of a generation of a worker's cache of pieces (two are held at most), and of its cache of words.
PIECES, WORDS = 150_000, 300_000
_NONE = np.iinfo(np.int32).max
_WORKER: dict = {}


class Merges:
    """The first ids of bytes, and the rank and result of each pair of ids that merges."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        letters = byte_letters()
        self.suffix = model.get("end_of_word_suffix") or ""
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[letters[b] + self.suffix] for b in range(256)], np.int32)
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        key = np.array([vocab[a] for a, _ in pairs], np.int64) << 32 | np.array([vocab[b] for _, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank = key[order], order.astype(np.int32)
        self.into = np.array([vocab[a + b] for a, b in pairs], np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; the largest number where a pair doesn't merge."""
        if not len(self.key):
            return np.full(left.shape, _NONE, np.int32)
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], _NONE)

    def merged(self, parts: np.ndarray) -> list[np.ndarray]:
        """parts: first ids of words of one length, a row each. The ids that remain of each row."""
        out: list = [None] * len(parts)
        name = np.arange(len(parts))
        ranks = self.ranks(parts[:, :-1], parts[:, 1:])
        while len(name):
            best = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(name), np.int64)
            least = ranks[np.arange(len(name)), best] if ranks.shape[1] else np.full(len(name), _NONE)
            done = np.flatnonzero(least == _NONE)
            if len(done):
                for i, x in zip(name[done].tolist(), parts[done], strict=True):
                    out[i] = x
                keep = np.flatnonzero(least != _NONE)
                name, parts, ranks, best, least = name[keep], parts[keep], ranks[keep], best[keep], least[keep]
                if not len(name):
                    break
            row, column = np.arange(len(name)), np.arange(parts.shape[1] - 1)
            # the boundary after part `best` goes: that part becomes the merged one, what follows moves up by one
            up = column[None, :] + (column[None, :] > best[:, None])
            parts = np.take_along_axis(parts, up, 1)
            parts[row, best] = self.into[least]
            ranks = np.take_along_axis(ranks, up[:, :-1] if parts.shape[1] else up, 1)
            before = np.flatnonzero(best > 0)
            ranks[before, best[before] - 1] = self.ranks(parts[before, best[before] - 1], parts[before, best[before]])
            after = np.flatnonzero(best < parts.shape[1] - 1)
            ranks[after, best[after]] = self.ranks(parts[after, best[after]], parts[after, best[after] + 1])
        return out

    def merged_long(self, parts: np.ndarray) -> np.ndarray:
        """The same for one long word, with a heap of (rank, place) and links between the parts that are left."""
        n = len(parts)
        ids = parts.tolist()
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(self.ranks(parts[:-1], parts[1:]).tolist()) if r != _NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j] = int(self.into[rank]), False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else n
                if x >= 0 and y < n:
                    r = int(self.ranks(np.array([ids[x]]), np.array([ids[y]]))[0])
                    if r != _NONE:
                        heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return np.array([x for x, ok in zip(ids, alive, strict=True) if ok], np.int32)

    def encode(self, data: list[bytes]) -> list[np.ndarray]:
        """Ids of words, given as bytes."""
        out: list = [np.zeros(0, np.int32)] * len(data)
        size = np.fromiter(map(len, data), np.int64, len(data))
        order = np.argsort(size, kind="stable")
        a = int(np.searchsorted(size[order], 0, "right"))
        while a < len(order):
            n = int(size[order[a]])
            if n > SHORT:
                raw = np.frombuffer(data[order[a]], np.uint8)
                out[order[a]] = self.merged_long(np.append(self.inner[raw[:-1]], self.last[raw[-1]]))
                a += 1
                continue
            b = min(int(np.searchsorted(size[order], n, "right")), a + ROWS)
            raw = np.frombuffer(b"".join(data[i] for i in order[a:b]), np.uint8).reshape(b - a, n)
            parts = self.inner[raw]
            parts[:, -1] = self.last[raw[:, -1]]
            for i, x in zip(order[a:b].tolist(), self.merged(parts), strict=True):
                out[i] = x
            a = b
        return out


class Encoder:
    """A worker's encoder for one definition: ids of whole texts."""

    def __init__(self, definition: str):
        described = json.loads(definition)
        self.merges, self.tokenizer = Merges(described["model"]), tokenizer_of(definition)
        self.letters = {c: b for b, c in byte_letters().items()}
        self.added = {x["content"]: x["id"] for x in described.get("added_tokens") or []}
        self.cut = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.specials = special_strings(definition)
        # words keep the space before them, or white space is dropped and letters are folded
        self.keeps_space = not self.merges.suffix
        self.cache, self.known = PieceCache(self.pieces, PIECES), {}

    def by_rule(self, text: str) -> Iterator[bytes | int]:
        """Words of any text by the definition's rules, as bytes, and ids of added tokens."""
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.added:
                yield self.added[part]
            elif part:
                if self.tokenizer.normalizer is not None:
                    part = self.tokenizer.normalizer.normalize_str(part)
                for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part):
                    yield bytes(map(self.letters.__getitem__, word))

    def pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of pieces, as little-endian 4-byte numbers. A word is merged once while it stands with different marks."""
        if len(self.known) > WORDS:
            self.known = {}
        known, found, fresh = self.known, [], {}
        for text in texts:
            if m := PLAIN.fullmatch(text):
                word, marks = m.groups()
                if not self.keeps_space:
                    word = word.lower()
                found.append((word, marks))
                if word not in known:
                    fresh[word] = None
                if marks and marks not in known:
                    fresh[marks] = None
            else:
                found.append([w if isinstance(w, int) else w.decode() for w in self.by_rule(text)])
                fresh.update((w, None) for w in found[-1] if not isinstance(w, int) and w not in known)
        for w, ids in zip(fresh, self.merges.encode([w.encode() for w in fresh]), strict=True):
            known[w] = ids.tobytes()
        out = []
        for x in found:
            if isinstance(x, tuple):
                out.append(known[x[0]] + known[x[1]] if x[1] else known[x[0]])
            else:
                out.append(b"".join(array("i", [w]).tobytes() if isinstance(w, int) else known[w] for w in x))
        return out

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one row after another, and the offset of each row."""
        raw, offsets = buffers(column)
        w = byte_level_pieces(raw, offsets) if self.keeps_space else words(raw, offsets, NOT_SPACE)
        if not len(w.start):
            return np.zeros(0, np.int32), np.zeros(len(column) + 1, np.int64)
        first, inverse = distinct(raw, w)
        data = raw.tobytes()
        kinds = self.cache.get([data[a:b] for a, b in zip(w.start[first], w.end[first], strict=True)])
        size = np.fromiter(map(len, kinds), np.int64, len(kinds)) >> 2
        flat, at = np.frombuffer(b"".join(kinds), np.int32), np.cumsum(size) - size
        n = size[inverse]
        total = np.concatenate([[0], np.cumsum(n)])
        ids, ends = flat[np.repeat(at[inverse] - total[:-1], n) + np.arange(total[-1])], total[w.first]
        if not self.keeps_space:
            return ids, ends
        # where the space before a word may not be its own (white space beyond ASCII, added tokens), a row is cut as a whole
        odd = odd_rows(raw, offsets, self.specials)
        if not len(odd):
            return ids, ends
        rows = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        for i in odd.tolist():
            found = list(self.by_rule(column[i].as_py()))
            encoded = iter(self.merges.encode([x for x in found if not isinstance(x, int)]))
            rows[i] = np.concatenate([np.array([x], np.int32) if isinstance(x, int) else next(encoded) for x in found])
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


class Decoder:
    """A worker's decoder for one definition: texts of ids."""

    def __init__(self, definition: str):
        described = json.loads(definition)
        entries = {i: t for t, i in described["model"]["vocab"].items()} | {x["id"]: x["content"] for x in described.get("added_tokens") or []}
        self.size = max(entries, default=-1) + 1
        self.known = np.zeros(self.size + 1, bool)
        self.known[list(entries)] = True
        self.by_bytes = (described.get("decoder") or {}).get("type") == "ByteLevel"
        if not self.by_bytes and described.get("decoder"):
            raise ValueError(f"no decoder of type {described['decoder']['type']} here")
        letters = {c: b for b, c in byte_letters().items()}
        texts = [entries.get(i, "") for i in range(self.size + 1)]
        self.entries = pa.array([bytes(map(letters.__getitem__, t)) if all(c in letters for c in t) else t.encode() for t in texts], pa.large_binary()) if self.by_bytes else pa.array(texts, pa.large_string())

    def __call__(self, column: pa.Array) -> pa.Array:
        """Texts of a list column of ids."""
        column = column.cast(pa.large_list(pa.int64()))
        if column.null_count:
            column = pa.array([x or [] for x in column.to_pylist()], column.type)
        ids, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy() - column.offsets[0].as_py()
        known = (ids >= 0) & (ids < self.size)
        known &= self.known[np.where(known, ids, self.size)]
        if not known.all():
            ends = np.concatenate([[0], np.cumsum(known)])[ends]
            ids = ids[known]
        tokens = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), self.entries.take(pa.array(ids)))
        if not self.by_bytes:
            return pc.binary_join(tokens, pa.scalar(" ", pa.large_string()))
        return pa.array([x.decode("utf-8", "replace") for x in pc.binary_join(tokens, pa.scalar(b"", pa.large_binary())).to_pylist()], pa.large_string())


def _on_worker(kind: type, definition: str):
    key = (kind.__name__, hash(definition))
    if key not in _WORKER:
        _WORKER[key] = kind(definition)
    return _WORKER[key]


def _definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def bpe_encoded(docs: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """``docs`` with the ids of each whole text (array of int) in place of the text. tokenizer: path of a .json file.

    decoded_col: what the ids decode to as well, by the same task, so that ids need not travel between workers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_definition(tokenizer))
    kept = [c for c in docs.columns if c not in (text_col, ids_col, decoded_col)]
    source = checked(docs, *kept, text_col)
    fields = [f for f in source.schema.fields if f.name != text_col] + [StructField(ids_col, ArrayType(IntegerType()))]
    fields += [StructField(decoded_col, StringType())] if decoded_col else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _on_worker(Encoder, shared.value)
        for batch in batches:
            for part in slices(batch, len(kept), TEXT):
                flat, ends = encode(part.column(len(kept)))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                more = [_on_worker(Decoder, shared.value)(ids).cast(pa.string())] if decoded_col else []
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids, *more], names=[f.name for f in fields])

    return source.mapInArrow(tidy(run), StructType(fields))


def bpe_decoded(rows: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of each array of ids in ``text_col``."""
    shared = rows.sparkSession.sparkContext.broadcast(_definition(tokenizer))
    kept = [c for c in rows.columns if c != text_col]
    source = checked(rows, *kept)
    schema = StructType([*source.schema.fields, StructField(text_col, StringType())])
    at = kept.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _on_worker(Decoder, shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, decode(part.column(at)).cast(pa.string())], names=[*kept, text_col])

    return source.mapInArrow(tidy(run), schema)
