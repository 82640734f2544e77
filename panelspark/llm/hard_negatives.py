"""Hard negatives by L2AP-style threshold joins (after Anastasiu and Karypis 2014) of anchors with all rows.

Vectors become whole numbers, so that scores (inner products) are exact. A set of anchors is sent to the tasks, and each task
joins the rows it reads with it, block by block:

1. Index. The dimensions of a block are ordered, the heaviest first, and cut into runs. A run of dimensions of a row is left out of
   the index where the product of the norms of what is left of the row and of an anchor (the suffix-norm bound) is below the threshold:
   no pair of that row could reach it by these dimensions alone. Rows whose whole norm falls short aren't indexed at all.
2. Partial scores are accumulated run by run over what is indexed. A pair whose partial score plus the product of the remaining norms
   is below its anchor's threshold is pruned; what survives is completed from the dimensions that are not indexed.
3. Windows. An anchor's thresholds begin high and are lowered step by step until its windows are full (``negatives`` scores in the
   window of each positive, ``positives`` scores of the same label), or down to the least that counts. A window that is full keeps its
   last score as its threshold for all later blocks of the task.

Two such joins follow one another, for positives and for negatives. Each begins with a small part of the rows (one in ``SEED``, by the hash
of the id), whose full windows are the first thresholds of all tasks on the rest; so a task returns only what may still count.
No row is moved: what is shuffled are the few rows that tasks return for each anchor. Anchors are sent ``ANCHOR_BYTES`` at a time, and
driver and tasks hold no more of them; each such part is a pass over the rows.

Defined results
* rows with a null id or label, a null or empty vector, or a null or non-finite component take no part.
* a row's other rows are those with another id. Anchors that repeat id, label and vector count once; of repeated rows each counts.
* vectors of different lengths have no score; each length is joined by itself. Ties: the smaller id first.
* scores are exact up to 2^53. Larger ones, which no usual embedding has, are those of double precision; components count as 1e150 at most, and
  a score beyond 64 bits becomes the largest or smallest number of 64 bits.
* no anchors, or an empty table: an empty table. Other columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checked, drop_stored, stored

#: Bytes of anchors sent at a time; rows of a block and anchors compared with it at a time; bytes of a block at most; runs of dimensions.
ANCHOR_BYTES, ROWS, ANCHORS, ROW_BYTES, RUNS = 16 << 20, 8192, 256, 16 << 20, 4
#: One row in so many gives the first thresholds.
SEED = 16
#: Thresholds on the way from the most that an anchor can score to the least that counts.
LEVELS = (0.9, 0.7, 0.5, 0.35, 0.2, 0.1, 0.0)


@dataclass
class Block:
    """Rows with vectors of one length: ids, labels, whole components."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray

    def __len__(self) -> int:
        return len(self.ids)

    def part(self, which) -> Block:
        return Block(self.ids[which], self.labels[which], self.x[which])

    def norms(self) -> np.ndarray:
        return np.sqrt((self.x * self.x).sum(1))


def whole(x: np.ndarray, scale: float) -> np.ndarray:
    """Components as whole numbers: floor(scale * x)."""
    return np.clip(np.floor(scale * x.astype(np.float64)), -1e150, 1e150)


class Join:
    """The threshold join of a few anchors with a block of rows. ``lower`` completes what reaches the thresholds it is given."""

    def __init__(self, anchors: Block, rows: Block, wanted: np.ndarray):
        """wanted: which pairs count, anchors by rows."""
        d = rows.x.shape[1]
        order = np.argsort(-(rows.x * rows.x).sum(0), kind="stable")
        self.cuts = sorted({round(d * i / RUNS) for i in range(RUNS + 1)})
        (self.q, self.q_left), (self.x, self.x_left) = ((x := b.x[:, order], self._left(x)) for b in (anchors, rows))
        self.open, self.partial = wanted.copy(), np.zeros(wanted.shape)
        #: Runs of dimensions of each row that are indexed and added so far.
        self.indexed = np.zeros(len(rows), np.int64)
        self.slack = 0.5 + 1e-9 * float(self.q_left[:, 0].max() * self.x_left[:, 0].max())
        #: What is complete: anchor, row, score.
        self.i, self.j, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def _left(self, x: np.ndarray) -> np.ndarray:
        """For each cut, the norm of what follows it."""
        after = np.concatenate([np.cumsum((x * x)[:, ::-1], 1)[:, ::-1], np.zeros((len(x), 1))], 1)
        return np.sqrt(after[:, self.cuts])

    def lower(self, thresholds: np.ndarray) -> None:
        """Complete every pair that scores its anchor's threshold or more."""
        least, most_left = thresholds.min(), self.q_left.max(0)
        for run in range(len(self.cuts) - 1):
            # rows whose dimensions from here on are not covered by the suffix-norm bound
            rows = np.flatnonzero((self.indexed == run) & (self.x_left[:, run] * most_left[run] >= least - self.slack))
            if len(rows):
                a, b = self.cuts[run], self.cuts[run + 1]
                self.partial[:, rows] += self.q[:, a:b] @ self.x[rows, a:b].T
                self.indexed[rows] = run + 1
        left = self.q_left[:, self.indexed] * self.x_left[np.arange(len(self.x)), self.indexed][None, :]
        i, j = np.nonzero(self.open & (self.partial + left >= thresholds[:, None] - self.slack))
        value, runs = self.partial[i, j], self.indexed[j]
        for run in np.unique(runs).tolist():
            at, rest = np.flatnonzero(runs == run), slice(self.cuts[run], None)
            if self.cuts[run] < self.x.shape[1]:
                for k in range(0, len(at), 1 << 16):
                    some = at[k : k + (1 << 16)]
                    value[some] += np.einsum("ij,ij->i", self.q[i[some], rest], self.x[j[some], rest])
        self.open[i, j] = False
        self.i, self.j, self.score = np.concatenate([self.i, i]), np.concatenate([self.j, j]), np.concatenate([self.score, value])


class Windows:
    """The first ``size`` scores so far, with their ids, of each window of each anchor.

    A window takes scores from ``low`` to ``high``, and none below ``least``, which other tasks have filled it with (anchors by windows).
    """

    def __init__(self, size: int, low: np.ndarray, high: np.ndarray, least: np.ndarray):
        self.size, self.low, self.high, self.least = size, low, high, np.maximum(low, least)
        self.scores, self.ids = np.full((*low.shape, size), -np.inf), np.zeros((*low.shape, size), np.int64)

    def needs(self, which: slice) -> np.ndarray:
        """What a row must score to come into each window; infinity for a window that takes nothing."""
        need = np.maximum(self.scores[which, :, -1], self.least[which])
        return np.where(need > self.high[which], np.inf, need)

    def join(self, which: slice, anchors: Block, rows: Block, same: bool) -> None:
        """Bring rows into the windows of anchors ``which``. same: rows of the anchor's label with another id; else rows of other labels."""
        if same:
            rows = rows.part(np.isin(rows.labels, anchors.labels))
        wanted = anchors.labels[:, None] == rows.labels[None, :]
        wanted = wanted & (anchors.ids[:, None] != rows.ids[None, :]) if same else ~wanted
        needs = self.needs(which)
        need = needs.min(1)
        if not wanted.any() or np.isposinf(need).all():
            return
        most = np.minimum(anchors.norms() * rows.norms().max() + 1, self.high[which].max(1))
        floor = np.maximum(need, -anchors.norms() * rows.norms().max() - 1)
        work = Join(anchors, rows, wanted)
        done = most < floor
        for level in LEVELS:
            thresholds = np.where(done, np.inf, floor + level * np.maximum(most - floor, 0))
            if not done.all():
                work.lower(thresholds)
                done |= self._full(which, work, thresholds, needs)
        for slot in range(self.low.shape[1]):
            inside = (work.score >= needs[work.i, slot]) & (work.score <= self.high[which][work.i, slot])
            self._add(which, slot, work.i[inside], rows.ids[work.j[inside]], work.score[inside])

    def _full(self, which: slice, work: Join, thresholds: np.ndarray, needs: np.ndarray) -> np.ndarray:
        """Anchors whose windows hold ``size`` scores of the threshold or more, or take nothing below it: nothing lower can come in."""
        full = np.ones(len(thresholds), bool)
        for slot in range(self.low.shape[1]):
            fits = (work.score >= np.maximum(thresholds[work.i], needs[work.i, slot])) & (work.score <= self.high[which][work.i, slot])
            found = np.bincount(work.i[fits], minlength=len(thresholds)) + (self.scores[which, slot] >= thresholds[:, None]).sum(1)
            full &= (found >= self.size) | (needs[:, slot] >= thresholds)
        return full

    def _add(self, which: slice, slot: int, i: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        touched = np.unique(i)
        if not len(touched):
            return
        held = self.scores[which, slot], self.ids[which, slot]
        i = np.concatenate([i, np.repeat(touched, self.size)])
        ids, scores = np.concatenate([ids, held[1][touched].reshape(-1)]), np.concatenate([scores, held[0][touched].reshape(-1)])
        order = np.lexsort((ids, -scores, i))
        i, ids, scores = i[order], ids[order], scores[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        top = rank < self.size
        held[0][i[top], rank[top]], held[1][i[top], rank[top]] = scores[top], ids[top]

    def rows(self) -> pa.RecordBatch:
        """anchor, slot, id, score of all that may count."""
        a, s, k = np.nonzero((self.scores > -np.inf) & (self.scores >= self.least[:, :, None]))
        score = np.clip(self.scores[a, s, k], -(2.0**63), np.nextafter(2.0**63, 0)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(s, pa.int32()), pa.array(self.ids[a, s, k]), pa.array(score)], names=["anchor", "slot", "id", "score"])


def _blocks(batch: pa.RecordBatch, scale: float) -> Iterator[Block]:
    """Rows (id, label, vector) of a batch by length of their vectors, in blocks of bounded size."""
    ids, labels, column = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
    width = column.value_lengths().to_numpy()
    for d in np.unique(width).tolist():
        at = np.flatnonzero(width == d)
        step = max(1, min(ROWS, ROW_BYTES // (8 * d)))
        for k in range(0, len(at), step):
            some = at[k : k + step]
            yield Block(ids[some], labels[some], whole(column.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d), scale))


class _Pass:
    """A part of the anchors, ordered by length of vectors and label, and its threshold joins with all rows."""

    def __init__(self, rows: DataFrame, part: pa.Table, scale: float):
        self.rows, self.scale = rows, scale
        blocks = sorted((b for batch in part.combine_chunks().to_batches() for b in _blocks(batch, scale)), key=lambda b: b.x.shape[1])
        self.blocks: list[Block] = []
        for d in sorted({b.x.shape[1] for b in blocks}):
            same = [b for b in blocks if b.x.shape[1] == d]
            whole_block = Block(*(np.concatenate([getattr(b, f) for b in same]) for f in ("ids", "labels", "x")))
            self.blocks.append(whole_block.part(np.lexsort((whole_block.ids, whole_block.labels))))
        self.ids = np.concatenate([b.ids for b in self.blocks])

    def join(self, size: int, low: np.ndarray, high: np.ndarray, same: bool) -> DataFrame:
        """anchor, slot, id, score, rank: the first ``size`` of each window (low to high, anchors by windows)."""
        least = np.full(low.shape, -np.inf)
        for seed in (True, False):
            found = self._once(size, low, high, least, same, seed)
            if seed:
                last = found.filter(F.col("rank") == size).select("anchor", "slot", "score").toArrow()
                least[last["anchor"].to_numpy(), last["slot"].to_numpy()] = last["score"].to_numpy()
        return found

    def _once(self, size: int, low: np.ndarray, high: np.ndarray, least: np.ndarray, same: bool, seed: bool) -> DataFrame:
        shared = self.rows.sparkSession.sparkContext.broadcast((self.blocks, low, high, least))
        scale = self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors, low, high, least = shared.value
            windows = Windows(size, low, high, least)
            for batch in batches:
                for rows in _blocks(batch, scale):
                    first = 0
                    for block in anchors:
                        if block.x.shape[1] == rows.x.shape[1]:
                            for a in range(0, len(block), ANCHORS):
                                some = block.part(slice(a, a + ANCHORS))
                                windows.join(slice(first + a, first + a + len(some)), some, rows, same)
                        first += len(block)
            yield windows.rows()

        rows = self.rows.filter(F.pmod(F.xxhash64("id"), F.lit(SEED)) == 0) if seed else self.rows
        order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
        found = rows.mapInArrow(run, "anchor int, slot int, id long, score long")
        return stored(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size), "windows")


def hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80, high_percent: int = 100, scale: float = 256.0, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """Of rows where ``anchors`` holds: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Positives are an anchor's first rows of its label, negatives of each the first rows of other labels with
    low_percent * positive_score <= 100 * negative_score <= high_percent * positive_score.
    """
    spark = vectors.sparkSession
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    keyed = vectors.withColumn("_anchor", F.coalesce(anchors, F.lit(False)))
    rows = checked(keyed, id_col, label_col, vector_col, "_anchor").toDF("id", "label", "x", "anchor")
    kind = vectors.schema[label_col].dataType.typeName()
    rows = rows.withColumns({"id": F.col("id").cast("long"), "label": F.col("label").cast("long") if kind in ("byte", "short", "integer", "long") else F.when(F.col("label").isNotNull(), F.xxhash64("label")), "x": F.col("x").cast("array<float>" if single else "array<double>")})
    fine = (F.size("x") > 0) & F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    asked = stored(rows.filter("anchor").select("id", "label", "x").dropDuplicates(), "anchors")
    rows = rows.select("id", "label", "x")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = None
    for part in _parts(asked):
        this = _Pass(rows, part, scale)
        n = len(this.ids)
        open_low, open_high = np.full((n, 1), -np.inf), np.full((n, 1), np.inf)
        first = this.join(positives, open_low, open_high, True)
        got = first.toArrow()
        drop_stored(spark, first)
        at = got["anchor"].to_numpy(), got["rank"].to_numpy() - 1
        names, scores = np.zeros((n, positives), np.int64), np.zeros((n, positives), np.int64)
        names[at], scores[at] = got["id"].to_numpy(), got["score"].to_numpy()
        low, high = np.full((n, positives), np.inf), np.full((n, positives), -np.inf)  # no window without a positive
        low[at], high[at] = -(-low_percent * scores[at] // 100), high_percent * scores[at] // 100
        found = this.join(negatives, low, high, False)
        shared = spark.sparkContext.broadcast((this.ids, names, scores))

        def named(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, names, scores = shared.value
            for b in batches:
                a, s = b.column(0).to_numpy(), b.column(1).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(names[a, s]), b.column(4), b.column(2), pa.array(scores[a, s]), b.column(3)], names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

        result = found.select("anchor", "slot", "id", "score", "rank").mapInArrow(named, schema)
        out = result if out is None else out.unionByName(result)
    return spark.createDataFrame([], schema) if out is None else out


def _parts(asked: DataFrame) -> Iterator[pa.Table]:
    """Anchors, some ``ANCHOR_BYTES`` of whole components at a time on the driver."""
    held, size = [], 0
    for r in asked.toLocalIterator():
        held.append(r)
        size += 8 * len(r.x)
        if size >= ANCHOR_BYTES:
            yield _table(held)
            held, size = [], 0
    if held:
        yield _table(held)


def _table(rows: list) -> pa.Table:
    return pa.table({"id": pa.array([r.id for r in rows], pa.int64()), "label": pa.array([r.label for r in rows], pa.int64()), "x": pa.array([r.x for r in rows], pa.list_(pa.float64()))})
