"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws the key ``-ln(u) / quality`` from a hash of its id and text, so reruns agree. A source first takes all
its documents as often as its target holds its whole size; the rest of the target is filled with documents in ascending
order of their keys, up to the prefix sum that comes nearest. Targets share the budget by weight, stop at ``most`` times
the source's size, and pass the excess on by weight (water filling, solved over the sources in order of cap to weight).

No source is ever sorted whole. The bits of a key place it in one of a few thousand ranges for each source; sums
of sizes for each range are pre-aggregated and show which single range holds the edge of a source. Ranges below are
taken, ranges above are not, and only the rows of the edge's range are sorted. A source with a third of all rows is
spread over its ranges.

Defined results
* sizes are runs without the white space 0x20, 0x09-0x0D; null or empty text has size 0 and is taken 0 times.
* sources are ordered by code point, null last, and get the weights in turn, repeating.
* rows with the same id, text and source are taken alike. Null ids are kept. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrowtext import ALNUM, NOT_SPACE, buffers, slices, words
from .shared import checked, packed, stored

#: Bits of a key's mantissa that tell ranges apart: 256 ranges for each doubling of the key.
MANTISSA_BITS = 8
#: The table of sources is broadcast up to so many rows; beyond it, it is joined by a shuffle.
BROADCAST_SOURCES = 100_000


def _sizes_and_keys(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: int) -> DataFrame:
    source = checked(docs, id_col, source_col, text_col)
    schema = source.drop(text_col).schema.add("_tie", "string").add("size", "long").add("_key", "double").add("_range", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                raw, offsets = buffers(part.column(2))
                size = np.diff(words(raw, offsets, NOT_SPACE).first)
                # quality weight: the share of letters and digits in what isn't white space
                shown = np.concatenate([[0], np.cumsum(NOT_SPACE[raw])])
                letters = np.concatenate([[0], np.cumsum(ALNUM[raw])])
                quality = (1.0 + np.diff(letters[offsets])) / (1.0 + np.diff(shown[offsets]))
                data = raw.tobytes()
                ties = [hashlib.md5(data[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                draws = [int(hashlib.md5(f"{i}:{tie}:{seed}".encode()).hexdigest()[:13], 16) for i, tie in zip(part.column(0).to_pylist(), ties, strict=True)]
                u = (np.array(draws, np.float64) + 0.5) / 2.0**52
                key = -np.log(u) / quality
                ranges = (key.view(np.int64) >> (52 - MANTISSA_BITS)).astype(np.int32) if len(key) else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ties, pa.string()), pa.array(size.astype(np.int64)), pa.array(key), pa.array(ranges)], names=schema.names)

    return source.mapInArrow(run, schema)


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """From (source, source_size): source, source_size, target. One row for each source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("_w", F.get(pick, (F.row_number().over(order) - 1) % len(weights))).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    # sources are full in the order of cap to weight; those before are full when this one's part of what they leave is above its cap
    full = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = (
        s.withColumn("_budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_left", F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_weights", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
        .withColumn("_full", F.col("_left") * F.col("_w") / F.col("_weights") >= F.col("_cap"))
    )
    first_open = F.min_by(F.struct("_left", "_weights"), F.when(~F.col("_full"), F.col("_cap") / F.col("_w"))).over(everything)
    return s.withColumn("_open", first_open).select("source", "source_size", F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_open._left") * F.col("_w") / F.col("_open._weights")).alias("target"))


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0, seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """For each row: id, size, source_size, target, taken (words taken, repeats counted), copies, source, _tie (hash of the text)."""
    stats = _sizes_and_keys(docs, id_col, source_col, text_col, seed).withColumnRenamed(source_col, "source")
    stats = stored(stats, "mix-stats")
    hist = stats.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    by_source = hist.groupBy("source").agg(F.sum("_sum").alias("source_size"))
    plan = (
        source_targets(by_source, weights, share, most)
        .withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
    )
    ranges = hist.withColumn("_before", F.sum("_sum").over(Window.partitionBy("source").orderBy("_range")) - F.col("_sum"))
    edge = (
        ranges.alias("r")
        .join(plan.alias("p"), F.col("r.source").eqNullSafe(F.col("p.source")))
        .groupBy("p.source", "source_size", "target", "_epochs", "_rest")
        .agg(F.min(F.when(F.col("_before") + F.col("_sum") > F.col("_rest"), F.struct("_range", "_before"))).alias("_edge"))
        .select(F.col("source").alias("_s"), "source_size", "target", "_epochs", (F.col("_rest") - F.col("_edge._before")).alias("_room"), F.coalesce(F.col("_edge._range"), F.lit(2**31 - 1)).alias("_cut"))
    )
    edge = stored(edge, "mix-plan")
    small = edge.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    rows = stats.join(F.broadcast(edge) if small else edge, F.col("source").eqNullSafe(F.col("_s")))
    sure = rows.filter(F.col("_range") != F.col("_cut")).withColumn("_more", (F.col("_range") < F.col("_cut")).cast("long"))
    # default frame: rows with equal keys, ids and texts share one prefix sum
    order = Window.partitionBy("source").orderBy("_key", F.col(f"`{id_col}`").asc_nulls_first(), "_tie")
    peers = Window.partitionBy("source", "_key", f"`{id_col}`", "_tie")
    middle = F.sum("size").over(order) - F.sum("size").over(peers) / F.lit(2.0)
    at_edge = rows.filter(F.col("_range") == F.col("_cut")).withColumn("_more", (middle <= F.col("_room")).cast("long"))
    both = sure.unionByName(at_edge)
    copies = F.when(F.col("size") > 0, F.col("_epochs") + F.col("_more")).otherwise(F.lit(0)).cast("long")
    return both.select(F.col(f"`{id_col}`"), "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), "source", "_tie")


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    taken = mix_sources(docs, id_col=id_col, source_col=source_col, text_col=text_col, **options)
    taken = taken.select(F.col(f"`{id_col}`").alias("_i"), F.col("source").alias("_s"), F.col("_tie").alias("_t"), F.col("copies").alias("_n")).filter("_n > 0").dropDuplicates(["_i", "_s", "_t"])
    left = packed(docs, _id=F.col(f"`{id_col}`"), _source=F.col(f"`{source_col}`"), _tie=F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")))
    both = left.join(taken, F.col("_id").eqNullSafe(F.col("_i")) & F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_tie") == F.col("_t")))
    return both.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select("_row.*")
