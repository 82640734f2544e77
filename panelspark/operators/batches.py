"""Next-fit batches over one stream of rows, without a task that holds the stream.

Where a batch begins depends on all batches before it, but where a batch that begins at some row would end depends on the sizes after it
alone: every row has a successor, and batches begin at the rows that are reached from the first. Rows are numbered and cut into
blocks. In a block, sizes are summed up and the successor of each row is a search in the sums; following successors leads out of the block,
from each row where a batch may enter it to one row of the next. These exits are a function of entries, and functions of
blocks are composed by pointer doubling: after k rounds the entries of 2^k blocks are known from the first. Then each block, by its
entry, numbers its batches. A batch has a bounded number of rows, so it leads into the next block at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.sources.files import stored

#: Rows of a block, at least four times what a batch can hold.
BLOCK = 1 << 17


def numbered(rows: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Rows numbered from 0 in an order, nulls last, by the numbers of rows of range partitions. The order must tell all rows apart."""
    by = [F.col(c).asc_nulls_last() for c in order]
    placed = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_id", 33)
    # a row for each partition
    sizes = sorted((r.p, r.n) for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    starts = dict(zip([p for p, _ in sizes], np.concatenate([[0], np.cumsum([n for _, n in sizes])[:-1]]).astype(int).tolist() if sizes else [], strict=True))
    before = F.create_map(*[F.lit(x) for p, s in starts.items() for x in (int(p), int(s))]) if starts else F.create_map().cast("map<int,int>")
    return placed.withColumn(name, (F.try_element_at(before, part.cast("int")) + F.col("_id").bitwiseAND((1 << 33) - 1)).cast("long")).drop("_id")


def successors(sizes: np.ndarray, limit: int, most: int) -> np.ndarray:
    """For each row the first row that a batch beginning there doesn't take; the number of rows where it takes all."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    here = np.arange(len(sizes))
    end = np.searchsorted(total, total[:-1] + limit, "right") - 1
    return np.minimum(np.maximum(end, here + 1), here + most)


def _block_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows of each block, from batches ordered by block and position. A block is bounded."""
    held: list[pa.RecordBatch] = []
    block = None
    for batch in batches:
        blocks = batch.column(0).to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(blocks[1:] != blocks[:-1]) + 1, [len(blocks)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if a == b:
                continue
            if block is not None and blocks[a] != block:
                yield block, pa.Table.from_batches(held)
                held = []
            block = int(blocks[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield block, pa.Table.from_batches(held)


def batched(rows: DataFrame, order: list[str], size: str, limit: int, most: int, block: int = BLOCK) -> DataFrame:
    """``rows`` with batch: numbers from 0 in the order. A batch closes when the next row would pass ``limit`` or be more than ``most``.

    A row above the limit is a batch of its own. Sizes are whole numbers, null and negative ones count as 0.
    """
    block = max(block, 4 * most)
    placed = numbered(rows, order, "_position").withColumn("_size", F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)))
    own = placed.withColumn("_block", F.floor(F.col("_position") / block))
    # the first rows of a block stand at the end of the block before as well, where its last batches reach into them
    ahead = own.filter((F.col("_position") % block < most) & (F.col("_block") > 0)).withColumn("_block", F.col("_block") - 1)
    in_blocks = lambda df, *more: df.select("_block", "_position", "_size", *more).repartition("_block").sortWithinPartitions("_block", "_position")

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, t in _block_arrays(batches):
            sizes, first = t.column(2).to_numpy(), b * block
            end = min(block, len(sizes))  # rows of the block itself
            succ = successors(sizes, limit, most)
            entries = np.arange(min(most, end)) if b else np.arange(min(1, end))
            at, count = entries.copy(), np.zeros(len(entries), np.int64)
            while (live := np.flatnonzero(at < end)).size:
                at[live], count[live] = succ[at[live]], count[live] + 1
            yield pa.RecordBatch.from_arrays([pa.array(entries + first), pa.array(at + first), pa.array(count)], names=["entry", "exit", "n"])

    jumps = stored(in_blocks(own.unionByName(ahead)).mapInArrow(exits, "entry long, exit long, n long"), "jumps")
    # entries that no block leads to are of no use; those that are left soon are few for each block
    jumps = stored(jumps.join(jumps.select(F.col("exit").alias("entry")).unionByName(jumps.filter("entry = 0").select("entry")).distinct(), "entry", "left_semi"), "jumps")
    spark = rows.sparkSession
    reached = spark.createDataFrame([(0, 0)], "entry long, before long")
    last = placed.agg(F.max("_position").alias("n")).first().n
    blocks = 0 if last is None else last // block + 1
    done = 1
    while done < blocks:
        step = jumps.withColumnRenamed("entry", "from")
        further = reached.join(step, F.col("entry") == F.col("from")).select(F.col("exit").alias("entry"), (F.col("before") + F.col("n")).alias("before"))
        reached = stored(reached.unionByName(further).dropDuplicates(["entry"]), "reached")
        twice = step.select(F.col("from").alias("entry"), F.col("exit").alias("via"), F.col("n").alias("n1"))
        jumps = stored(twice.join(step, F.col("via") == F.col("from")).select("entry", "exit", (F.col("n1") + F.col("n")).alias("n")), "jumps")
        done *= 2

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, t in _block_arrays(batches):
            sizes = t.column(2).to_numpy()
            own_rows = np.flatnonzero(t.column(1).to_numpy() < (b + 1) * block)
            at, before = t.column(3)[0].as_py() - b * block, t.column(4)[0].as_py()
            succ = successors(sizes, limit, most).tolist()
            begins = []
            while at < len(own_rows):
                begins.append(at)
                at = succ[at]
            batch = before + np.searchsorted(np.array(begins, np.int64), np.arange(len(own_rows)), "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(own_rows + b * block), pa.array(batch.astype(np.int64))], names=["_position", "batch"])

    # the exit of the last block is no entry, though it may lie in that block
    entries = reached.filter(F.col("entry") <= F.lit(last)).select(F.floor(F.col("entry") / block).alias("_block"), F.col("entry").alias("_entry"), F.col("before").alias("_before"))
    numbers = in_blocks(own.unionByName(ahead).join(entries, "_block"), "_entry", "_before").mapInArrow(number, "_position long, batch long")
    return placed.join(numbers, "_position").select(*rows.columns, "batch")
