"""Token counts of whole texts, without shuffling a pre-token.

Two tiers. The first is a compact hash table that is broadcast: the 64-bit hashes of frequent pre-tokens, sorted,
with their lengths in tokens. Frequent pre-tokens are the entries of the vocabulary, which training ranked by
frequency, with and without a space before and with a capital; their number is bounded by the vocabulary's, and the
library gives their lengths. Pre-tokens that miss it go to a cache of the worker, which asks the library.
Both tiers stay map-side: rows keep their place and no exchange is planned.

Defined results: null is an empty text with 0 tokens; special strings inside a text count as the library's default
has them; every row gives one row, repeated rows and null ids too; an empty table gives an empty table; other
columns are kept unless they have the name of a result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrowtext import Words, buffers, hashes, slices
from .pretokens import PieceCache, PieceEncoder, byte_letters, byte_level_pieces, odd_rows, special_strings, tokenizer_of
from .shared import checked, tidy

_WORKER: dict = {}


def frequent_table(definition: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and token lengths of the frequent pre-tokens (at most four for each entry of the vocabulary)."""
    t = tokenizer_of(definition)
    letters = {c: b for b, c in byte_letters().items()}
    found = set()
    for entry in json.loads(definition)["model"]["vocab"]:
        try:
            word = bytes(letters[c] for c in entry).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        bare = word.removeprefix(" ")
        if bare and not any(c.isspace() for c in bare):
            found |= {bare, " " + bare, bare.capitalize(), " " + bare.capitalize()}
    for blank in (" ", "\n", "\t", "\n\n", "  ", "   ", "    "):
        found.add(blank)
    specials = [s.decode() for s in special_strings(definition)]
    pieces = sorted(x for x in found if not any(s in x for s in specials))
    n = np.array([len(e.ids) for e in t.encode_batch_fast(pieces, add_special_tokens=False)], np.uint16)
    data = [p.encode() for p in pieces]
    raw = np.frombuffer(b"".join(data), np.uint8)
    ends = np.cumsum([len(d) for d in data])
    h = hashes(raw, Words(np.concatenate([[0], ends[:-1]]), ends, np.array([0, len(ends)])), fold=False)
    order = np.argsort(h)
    return h[order], n[order]


def is_byte_level(definition: str) -> bool:
    pre = json.loads(definition).get("pre_tokenizer") or {}
    return pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not json.loads(definition).get("normalizer")


def count_batch(batch: pa.RecordBatch, text: int, definition: str, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Tokens of each row of a batch."""
    key = hash(definition)
    if key not in _WORKER:
        encoder = PieceEncoder(definition, fold=False)
        _WORKER[key] = (encoder.tokenizer, PieceCache(lambda pieces: [len(x) >> 2 for x in encoder(pieces)]), special_strings(definition), is_byte_level(definition))
    tokenizer, cache, specials, pieces_hold = _WORKER[key]
    encode = lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    column = batch.column(text)
    if not pieces_hold:
        return np.array(encode([x or "" for x in column.to_pylist()]), np.int64)
    raw, offsets = buffers(column)
    if not len(raw):
        return np.zeros(batch.num_rows, np.int64)
    w = byte_level_pieces(raw, offsets)
    h = hashes(raw, w, fold=False)
    kinds, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    at = np.minimum(np.searchsorted(table[0], kinds), max(len(table[0]) - 1, 0))
    hit = table[0][at] == kinds
    length = np.where(hit, table[1][at], 0).astype(np.int64)
    missed = np.flatnonzero(~hit)
    data = raw.tobytes()
    if len(missed):
        length[missed] = cache.get([data[a:b] for a, b in zip(w.start[first[missed]], w.end[first[missed]], strict=True)])
    total = np.concatenate([[0], np.cumsum(length[inverse])])
    out = total[w.first[1:]] - total[w.first[:-1]]
    odd = odd_rows(raw, offsets, specials)
    for i in odd:
        out[i] = encode([column[int(i)].as_py()])[0]
    return out


def token_counts(docs: DataFrame, tokenizer: str, text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > limit) in place of the text. tokenizer: path of a .json file."""
    spark: SparkSession = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    table = frequent_table(definition) if is_byte_level(definition) else (np.zeros(1, np.uint64), np.zeros(1, np.uint16))
    shared = spark.sparkContext.broadcast((definition, table))
    added = ("n_bytes", "n_tokens", "over_limit")
    kept = [c for c in docs.columns if c != text_col and c not in added]
    source = checked(docs, *kept, text_col)
    schema = source.drop(text_col).schema.add("n_bytes", "long").add("n_tokens", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition, table = shared.value
        for batch in batches:
            for part in slices(batch, len(kept)):
                n = count_batch(part, len(kept), definition, table)
                _, offsets = buffers(part.column(len(kept)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(np.diff(offsets)), pa.array(n)], names=[*kept, "n_bytes", "n_tokens"])

    return source.mapInArrow(tidy(run), schema).withColumn("over_limit", F.col("n_tokens") > limit)
