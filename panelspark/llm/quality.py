"""Quality classifier on supervised subword embeddings, trained with numpy.

A document is the average of the vectors of its features: its words, pairs of words in a row, runs of ``RUN`` words up to renaming
(which of them are the same, whatever they are), and the character n-grams (of bytes) of its running text, white space being one
space, all hashed into buckets. A softmax layer turns the
average into class probabilities; vectors and layer are learned together by stochastic gradient descent. The layer is linear,
so after training each bucket is worth one number, the model is a table of ``BUCKETS`` floats, and scoring a text adds up the
worth of its features. Texts are scored where they are read.

Training is done on the driver on a bounded sample: about ``TRAIN_DOCS`` labelled documents, those whose hash of the id is
under a bound set by their number, and of an id with several texts the one of least hash; documents in training are used whole, whatever
their length. Scoring covers every whole text.

Defined results: null or empty text has no feature and gets the score of the bias; without labels of both classes
every score is 0.5; several labels of an id are averaged (0.5 and more counts as 1), null labels are left out; a null id is
never in training; repeated rows give a row each; an empty table gives an empty table. Features of a very long text are made
piece by piece, so a task needs some 40 bytes for each of its bytes. Extra columns, whatever their names, are left out of scores
and kept by ``good_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrowtext import NOT_SPACE, buffers, hashes, mix, slices, words
from .shared import checked, hash_share, tidy

TRAIN_DOCS = 3000
BUCKETS, DIMENSIONS, RATE, STEP = 1 << 18, 8, 0.5, 20
#: Steps of gradient descent, one document each: so many, and at least so many passes.
STEPS, PASSES = 16_000, 6
#: Words in a run whose equal ones are told.
RUN = 4
#: Lengths of character n-grams, in bytes.
GRAMS = (2, 3, 4)
#: Bytes whose n-grams are made at a time.
PIECE = 1 << 18


def one_space(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with every run of white space made one space."""
    space = ~NOT_SPACE[raw]
    again = space.copy()
    again[1:] &= space[:-1]
    again[offsets[:-1][offsets[:-1] < len(raw)]] = False  # a row begins anew
    again[:1] = False
    out = np.where(space, np.uint8(32), raw)[~again]
    return out, offsets - np.concatenate([[0], np.cumsum(again)])[offsets]


def features(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features of rows, piece by piece: the row and the bucket of each."""
    raw, offsets = one_space(raw, offsets)
    n = len(offsets) - 1
    w = words(raw, offsets, NOT_SPACE)
    h = hashes(raw, w, fold=False)
    row = np.repeat(np.arange(n), np.diff(w.first))
    for a in range(0, len(h), PIECE // 4):
        b = min(a + PIECE // 4, len(h))
        yield row[a:b], _bucket(h[a:b] ^ np.uint64(0xABCD))
        nxt = h[a + 1 : b + 1]
        one = row[a : a + len(nxt)]
        same = one == row[a + 1 : b + 1]
        yield one[same], _bucket(h[a : a + len(nxt)][same] * np.uint64(0x9E3779B97F4A7C15) + nxt[same])
        begin = np.arange(a, min(b, len(h) - RUN + 1))
        begin = begin[row[begin] == row[begin + RUN - 1]]
        yield row[begin], _bucket(_renamed(h, begin))
    for a in range(0, len(raw), PIECE):
        here = min(PIECE, len(raw) - a)
        text = np.zeros(here + max(GRAMS) - 1, np.uint64)
        seen = raw[a : a + len(text)]
        text[: len(seen)] = seen
        rows = np.searchsorted(offsets, np.arange(a, a + here), "right") - 1
        left = offsets[rows + 1] - np.arange(a, a + here)
        key = text[:here].copy()
        for k in range(2, max(GRAMS) + 1):
            key |= text[k - 1 : k - 1 + here] << np.uint64(8 * (k - 1))
            if k in GRAMS:
                ok = left >= k
                yield rows[ok], _bucket(key[ok] ^ (np.uint64(k) << np.uint64(56)))


def _renamed(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A key for each run of words: the place of the first equal word for each of its words."""
    key = np.full(len(begin), 0x5EED, np.uint64)
    for i in range(1, RUN):
        first = np.full(len(begin), i, np.uint64)
        for j in range(i - 1, -1, -1):
            first[h[begin + j] == h[begin + i]] = j
        key = key * np.uint64(RUN) + first
    return key


def _bucket(key: np.ndarray) -> np.ndarray:
    return (mix(key) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's features, and the share of each."""
    raw = np.frombuffer(text.encode(), np.uint8)
    count = np.zeros(BUCKETS, np.int64)
    for _, ids in features(raw, np.array([0, len(raw)])):
        np.add.at(count, ids, 1)
    ids = np.flatnonzero(count)
    return ids.astype(np.int32), (count[ids] / max(count.sum(), 1)).astype(np.float32)


def train(texts: list[str], labels: np.ndarray, seed: int = 1) -> tuple[np.ndarray, float]:
    """The worth of each bucket and the bias: score = sigmoid(mean worth of features + bias)."""
    worth, bias = np.zeros(BUCKETS, np.float32), 0.0
    if len(set(labels.tolist())) < 2:
        return worth, bias
    bags = [bag(t) for t in texts]
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer, offset = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    # classes weigh alike in the loss; their share comes back with the bias below
    share = np.bincount(labels, minlength=2) / len(labels)
    weight = 0.5 / share
    steps = max(STEPS, PASSES * len(bags))
    order = np.concatenate([rng.permutation(len(bags)) for _ in range(-(-steps // len(bags)))])[:steps]
    for done, i in enumerate(order):
        ids, part = bags[i]
        rate = RATE * (1 - done / steps)
        if not len(ids):
            continue
        hidden = part @ vectors[ids]
        logit = hidden @ layer + offset
        p = np.exp(logit - logit.max())
        p /= p.sum()
        p[labels[i]] -= 1
        p *= weight[labels[i]]
        back = layer @ p
        layer -= rate * np.outer(hidden, p)
        offset -= rate * 0.1 * p
        # a rare feature is a small part of few documents, so its vector takes long steps; a frequent one doesn't need them
        vectors[ids] -= (rate * np.minimum(STEP * part, 0.1))[:, None] * back[None, :]
    worth = vectors @ (layer[:, 1] - layer[:, 0])
    return worth.astype(np.float32), float(offset[1] - offset[0] + np.log(share[1] / share[0]))


def score_column(column: pa.Array, worth: np.ndarray, bias: float) -> np.ndarray:
    """Scores of a string column."""
    raw, offsets = buffers(column)
    total, number = np.zeros(len(column)), np.zeros(len(column))
    for rows, ids in features(raw, offsets):
        total += np.bincount(rows, worth[ids], len(column))
        number += np.bincount(rows, minlength=len(column))
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(number, 1) + bias, -40, 40)))


def held_out(id_col: str) -> Column:
    """Rows whose crc32 of the id as text leaves 1 when divided by 3; labels are never learned from them."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray, float]:
    """Train on a bounded sample of the labelled documents that are not held out."""
    known = checked(labels, id_col, label_col).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("y")).filter("id IS NOT NULL AND y IS NOT NULL").filter(~held_out("id"))
    known = known.groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    texts = checked(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t")).filter("t IS NOT NULL AND t <> ''")
    # ids are drawn by a bound on their hash before texts are joined, so what is broadcast and collected is bounded, and each run draws the same
    chosen = known.filter(hash_share(F.xxhash64("id"), TRAIN_DOCS, known.count()))
    drawn = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min_by("t", F.xxhash64("t")).alias("t"), F.min("y").alias("y"))
    rows = sorted(drawn.collect(), key=lambda r: (str(r.id), r.t))
    return train([r.t for r in rows], np.array([r.y for r in rows], np.int64))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", least: float | None = None) -> DataFrame:
    """For each row of ``docs``: id, held_out, score, predicted. least: whole rows that score so much or more instead."""
    worth, bias = fit(docs, labels, id_col, text_col, label_col)
    shared = docs.sparkSession.sparkContext.broadcast((worth, bias))
    kept = [id_col] if least is None else docs.columns
    carry = [c for c in kept if c != text_col]
    source = checked(docs, *carry, text_col)
    schema = checked(docs, *kept).schema
    if least is None:
        schema = schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worth, bias = shared.value
        for batch in batches:
            for part in slices(batch, len(carry)):
                columns = dict(zip(carry, part.columns, strict=False)) | {text_col: part.column(len(carry))}
                scores = score_column(part.column(len(carry)), worth, bias)
                if least is None:
                    yield pa.RecordBatch.from_arrays([*[columns[c] for c in kept], pa.array(scores)], names=schema.names)
                else:
                    yield pa.RecordBatch.from_arrays([columns[c] for c in kept], names=kept).filter(pa.array(scores >= least))

    out = source.mapInArrow(tidy(run), schema)
    if least is not None:
        return out
    return out.withColumn("held_out", held_out(id_col)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, least: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with their columns."""
    return quality_scores(docs, labels, least=least, **options)
