"""Near-duplicate vectors by an epsilon grid order join (Böhm, Braunmüller, Krebs, Kriegel 2001).

For unit vectors, cosine >= c is a distance of at most eps = sqrt(2 - 2c). Vectors are turned to principal axes, which keeps
distances, and sorted by their grid cells of width eps on the leading axes. Runs of that sequence are blocks with a
bounding box on the leading axes; pairs of sequence intervals are joined recursively, and an interval pair whose boxes are
farther apart than eps is skipped with all it holds. What survives are pairs of blocks; each is compared in one task,
again by intervals, with products of double-precision matrices.

Equal vectors are one class first, so a vector that a third of all rows repeat costs nothing. A task returns how many
links each vector has and a spanning forest of its links, never the links themselves, so output stays linear.

Blocks hold ``BLOCK`` vectors, or fewer wide ones (``BLOCK_BYTES``), whatever the size of the table. Their boxes are broadcast in runs of ``BOXES``, one at a time, so
neither the driver nor a task holds more of them. The axes come from sums of products of all components, d x d numbers, which
tasks add up in a tree.

Defined results: components are scaled by the largest of a vector before they are squared, so very large and very small
vectors count like others. Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing: n_links 0,
component_id their own id, kept true. Vectors of different lengths don't link; each length is
a join of its own. Rows that share a vec_id are one node, and their links add up. A null vec_id links with
nothing and has component_id null, kept true. Ids that are not whole numbers are numbered in their order first. An empty table gives an empty table; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import by_numbers, checked, stored

#: Axes of the grid, axes of the boxes, vectors of a block, boxes broadcast at a time (some 50 MB), vectors of an interval inside a task.
GRID_AXES, BOX_AXES, BLOCK, BOXES, INTERVAL = 4, 16, 8192, 200_000, 256
#: Bytes of a block in double precision at most, however wide its vectors are.
BLOCK_BYTES = 32 << 20
#: Parts of a table of blocks at most, and sums of the axes in the middle of their tree.
PARTS, SUMS = 4096, 32
#: Partner blocks that share one copy of a block.
RUN = 8


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Unit vectors of a list column without nulls, in double precision."""
    return _unit(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _axes(vectors: DataFrame, d: int) -> np.ndarray:
    """Principal axes as columns, the widest first: from the sums of products of all components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean, n = np.zeros((d, d)), np.zeros(d), 0
        for batch in batches:
            x = _matrix(batch.column(0), d)
            total += x.T @ x
            mean += x.sum(0)
            n += len(x)
        yield sums(np.concatenate([total.reshape(-1), mean, [n]]))

    def sums(numbers: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([numbers.tobytes()], pa.binary())], names=["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = np.zeros(d * d + d + 1)
        for batch in batches:
            for x in batch.column(0):
                got += np.frombuffer(x.as_py(), np.float64)
        yield sums(got)

    parts = vectors.select("embedding").mapInArrow(run, "sums binary")
    got = np.frombuffer(parts.repartition(SUMS).mapInArrow(add, "sums binary").repartition(1).mapInArrow(add, "sums binary").first().sums, np.float64)
    n = max(got[-1], 1)
    mean = got[d * d : d * d + d] / n
    _, axes = np.linalg.eigh(got[: d * d].reshape(d, d) / n - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, ::-1])


def distance2(low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray) -> np.ndarray:
    """Least squared distance between boxes."""
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return (gap * gap).sum(-1)


def near_intervals(low: np.ndarray, high: np.ndarray, box_low: np.ndarray, box_high: np.ndarray, eps2: float, first: int = 0) -> np.ndarray:
    """Boxes of a sequence, from ``first`` on, that may hold something within eps of a box. Halves of the sequence are skipped whole."""
    found, stack = [], [(first, len(low))]
    while stack:
        a, b = stack.pop()
        if a >= b:
            continue
        if b - a <= 16:
            hit = distance2(low[a:b], high[a:b], box_low, box_high) <= eps2
            found.append(np.flatnonzero(hit) + a)
            continue
        if distance2(low[a:b].min(0), high[a:b].max(0), box_low, box_high) > eps2:
            continue
        mid = (a + b) // 2
        stack += [(mid, b), (a, mid)]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def join_blocks(x: np.ndarray, y: np.ndarray, axes: np.ndarray, cosine: float, same: bool, eps2: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of unit vectors x and y with cosine >= ``cosine``; with ``same`` only i < j. Works interval by interval.

    axes: the leading principal axes, on which the boxes of intervals are taken.
    """
    px, py = x @ axes, y @ axes
    ends = lambda m: [(a, min(a + INTERVAL, len(m))) for a in range(0, len(m), INTERVAL)]
    spans_x, spans_y = ends(x), ends(y)
    low, high = (np.stack([f(py[a:b], 0) for a, b in spans_y]) for f in (np.min, np.max))
    for k, (a, b) in enumerate(spans_x):
        for m in near_intervals(low, high, px[a:b].min(0), px[a:b].max(0), eps2, k if same else 0):
            c, e = spans_y[m]
            hit = x[a:b] @ y[c:e].T >= cosine
            i, j = np.nonzero(hit)
            i, j = i + a, j + c
            if same:
                ok = i < j
                i, j = i[ok], j[ok]
            if len(i):
                yield i, j


class _Forest:
    """Components of the nodes of a task. Links come tile by tile, and only those that join something are looked at one by one."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
        """The links among (a, b), ordered by a, that join components."""
        fresh = np.flatnonzero(self.label[a] != self.label[b])
        if not len(fresh):
            return
        a, b = a[fresh], b[fresh]
        for x, near in zip(*_runs_of(a, b), strict=True):
            near = near[self.label[near] != self.label[x]]
            if len(near):
                others, first = np.unique(self.label[near], return_index=True)
                yield from ((int(x), int(y)) for y in near[first])
                self.label[np.isin(self.label, others)] = self.label[x]


def _runs_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct values of the ordered ``a``, and for each its part of ``b``."""
    starts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    return a[starts], np.split(b, starts[1:])


def _links(vectors: DataFrame, d: int, cosine: float) -> DataFrame:
    """vectors: (rep, m, embedding), m copies of each. Rows (a, b, n): a link between a and b (b null: none), n links added to a."""
    spark = vectors.sparkSession
    # a hair of room for rounding in the turn; the cosine itself decides
    eps2 = max(0.0, 2 - 2 * cosine) + 1e-9
    axes = spark.sparkContext.broadcast(_axes(vectors, d))
    width = float(np.sqrt(eps2))
    grid, box = min(GRID_AXES, d), min(BOX_AXES, d)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch.column(2), d) @ axes.value[:, :box]
            cells = np.floor(y[:, :grid] / width).astype(np.int32)
            head = pa.FixedSizeListArray.from_arrays(pa.array(y[:, :2].copy().reshape(-1)), y[:, :2].shape[1]).cast(pa.list_(pa.float64()))
            cell = pa.FixedSizeListArray.from_arrays(pa.array(cells.reshape(-1)), grid).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), head, cell], names=["rep", "m", "x", "y", "cell"])

    # vectors travel as they came, in single precision if so; tasks compute in double precision
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind = np.dtype("<f4" if element == "float" else "<f8")
    turned = stored(vectors.select("rep", "m", "embedding").mapInArrow(turn, f"rep long, m long, x array<{element}>, y array<double>, cell array<int>"), "turned")
    n = turned.count()
    size = max(1, min(BLOCK, BLOCK_BYTES // (8 * d)))
    n_parts = max(1, min(PARTS, -(-n // size)))
    order = [*[F.get("cell", F.lit(i)) for i in range(grid)], *[F.get("y", F.lit(i)) for i in range(min(2, d))], F.col("rep")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, rows = TaskContext.get().partitionId(), 0, []

        def block(rows: list[pa.RecordBatch]):
            x = np.concatenate([r.column(2).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, d) for r in rows])
            y = _unit(x) @ axes.value[:, :box]
            rep, m = (np.concatenate([r.column(i).to_numpy() for r in rows]) for i in (0, 1))
            lists = [pa.array([v.tolist()]) for v in (y.min(0), y.max(0))]
            return pa.RecordBatch.from_arrays([pa.array([part * 1_000_000 + number]), pa.array([rep.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()), *lists], names=["block", "reps", "ms", "xs", "low", "high"])

        held = 0
        for batch in batches:
            while batch.num_rows:
                take = min(batch.num_rows, size - held)
                rows.append(batch.slice(0, take))
                batch = batch.slice(take)
                held += take
                if held == size:
                    yield block(rows)
                    number, rows, held = number + 1, [], 0
        if rows:
            yield block(rows)

    sequence = turned.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    blocks = stored(sequence.mapInArrow(cut, "block long, reps binary, ms binary, xs binary, low array<double>, high array<double>"), "blocks")
    pairs = None
    for ids, low, high in _box_runs(blocks):
        table = spark.sparkContext.broadcast((ids, low, high))

        def partners(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            ids, low, high = table.value
            for batch in batches:
                lows, highs = (np.array(batch.column(i).to_pylist()).reshape(batch.num_rows, -1) for i in (1, 2))
                for i, b in enumerate(batch.column(0).to_pylist()):
                    near = near_intervals(low, high, lows[i], highs[i], eps2, int(np.searchsorted(ids, b)))
                    run = np.arange(len(near)) // RUN
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(near), b)), pa.array(run + int(ids[0])), pa.array(ids[near])], names=["left", "run", "block"])

        found = stored(blocks.select("block", "low", "high").mapInArrow(partners, "left long, run long, block long"), "block-pairs")
        table.destroy()
        pairs = found if pairs is None else pairs.unionByName(found)
    if pairs is None:
        return spark.createDataFrame([], "a long, b long, n long")
    with_left = pairs.select("left", "run", F.col("left").alias("block"), F.lit(0).alias("side")).distinct().unionByName(pairs.withColumn("side", F.lit(1)))
    groups = with_left.join(blocks.drop("low", "high"), "block").repartition("left", "run").sortWithinPartitions("left", "run", "side", "block")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            for i in range(batch.num_rows):
                block, key, side = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(3)[i].as_py()
                rep, m = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in (4, 5))
                x = _unit(np.frombuffer(batch.column(6)[i].as_py(), kind).reshape(-1, d))
                if side == 0:
                    left = (rep, m, x)
                    continue
                rep_l, m_l, x_l = left
                more_l, more_r = np.zeros(len(rep_l), np.int64), np.zeros(len(rep), np.int64)
                same, beyond = key == block, 0 if key == block else len(rep_l)
                found, nodes = _Forest(beyond + len(rep)), rep if same else np.concatenate([rep_l, rep])
                out: list[tuple[int, int | None, int]] = []
                for a, b in join_blocks(x_l, x, axes.value[:, :box], cosine, same, eps2):
                    np.add.at(more_l, a, m[b])
                    np.add.at(more_r, b, m_l[a])
                    out += [(int(nodes[p]), int(nodes[q]), 0) for p, q in found.join(a, b + beyond)]
                for names, more in ((rep_l, more_l), (rep, more_r)):
                    at = np.flatnonzero(more)
                    out += [(p, None, c) for p, c in zip(names[at].tolist(), more[at].tolist(), strict=True)]
                if out:
                    a, b, c = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64())], names=["a", "b", "n"])

    return groups.select("block", "left", "run", "side", "reps", "ms", "xs").mapInArrow(compare, "a long, b long, n long")


def _box_runs(blocks: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, low and high corners of the blocks in the order of the sequence, ``BOXES`` at a time."""
    rows = []

    def run():
        return np.array([r.block for r in rows], np.int64), *(np.array([r[i] for r in rows]).reshape(len(rows), -1) for i in (1, 2))

    for r in blocks.select("block", "low", "high").orderBy("block").toLocalIterator():
        rows.append(r)
        if len(rows) == BOXES:
            yield run()
            rows = []
    if rows:
        yield run()


def near_vectors(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row: id, n_links, component_id, kept."""
    return by_numbers(checked(vectors, id_col, vector_col), id_col, lambda rows: _near_vectors(rows, cosine, id_col, vector_col), "component_id")


def _near_vectors(vectors: DataFrame, cosine: float, id_col: str, vector_col: str) -> DataFrame:
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    source = checked(vectors, id_col, vector_col).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<float>" if single else "array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(fine, F.lit(False)) & F.col("id").isNotNull()
    keyed = source.select("id", "embedding", usable.alias("ok"), F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit("second"), "embedding").alias("k2"), F.size("embedding").alias("d"))
    classes = stored(keyed.filter("ok").groupBy("d", "k1", "k2").agg(F.min("id").alias("rep"), F.count("*").alias("m"), F.first("embedding").alias("embedding")), "classes")
    lengths = [r.d for r in classes.select("d").distinct().orderBy("d").collect()]
    spark = vectors.sparkSession
    links = spark.createDataFrame([], "a long, b long, n long")
    for d in lengths:
        links = links.unionByName(_links(classes.filter(F.col("d") == d), d, cosine))
    links = stored(links, "vector-links")
    counts = links.groupBy("a").agg(F.sum("n").alias("n")).filter("n > 0")
    named = classes.select("d", "k1", "k2", "rep", "m")
    # an id with several vectors links their classes
    twice = keyed.filter("ok").groupBy("id").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).filter("lo <> hi").select("id")
    same_id = keyed.filter("ok").join(twice, "id").join(named, ["d", "k1", "k2"]).select(F.col("id").alias("a"), F.col("rep").alias("b"))
    comps = stored(components(links.filter("b IS NOT NULL").select("a", "b").unionByName(same_id)), "components")
    return (
        keyed.drop("embedding")
        .join(named.withColumn("ok", F.lit(True)), ["ok", "d", "k1", "k2"], "left")
        .join(counts.withColumnRenamed("a", "rep"), "rep", "left")
        .join(comps.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce(F.col("n") + F.col("m") - 1, F.col("m") - 1, F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "rep", "id").alias("component_id"),
        )
        .withColumn("kept", F.col(f"`{id_col}`").isNull() | (F.col(f"`{id_col}`") == F.col("component_id")))
    )
