"""Near-duplicate documents: fast similarity sketches, banding, and verification on full sets.

1. Documents become sets of word shingles (64-bit hashes), sketches and band keys in the task that reads them; only these
   leave it. Documents with the same set are one class from here on, whatever their number.
2. Classes that share a band key are candidates: a bucket. Bands are as many as keep the chance that a pair just at the
   threshold shares none under ``MISS``. Buckets with the same members count once.
3. Hub rounds. The hub of a bucket is its member with the least hash, so overlapping buckets have the same hub; a member is
   verified against one hub, the least of those of its buckets. A round has a row for each member, however large
   a bucket is, and joins what is alike to components. Buckets within one component are done.
4. Certificates. In the buckets left, a shingle that one class alone holds can't be shared. A class with so many of them that
   no partner could reach the threshold leaves the buckets.
5. The rest is verified completely, between components only. Overlapping buckets are one group where that means fewer rows;
   a group is its largest component and the others, both in blocks of bounded size; the others meet every block, the blocks
   of the largest component don't meet each other. A set is sent once to a pair of blocks, and tasks return spanning
   forests of what they link, never the pairs.
Links of all steps make the final components. Nothing is capped, and no row is lost to a large bucket. What can still grow
faster than a group is the rest of a group whose classes lie just around the threshold of each other and share their
shingles: there blocks meet blocks.

Defined results
* fewer words than a shingle: the whole sequence is the one shingle. No words (null too): an empty set, linked with nothing.
* rows that share a doc_id are one node: what links one of them links the other. Null doc_id: linked with nothing,
  component_id null, kept true. Ids that are not whole numbers are numbered in their order first. An empty table gives an empty table. Other columns are left out (``near_deduplicated`` keeps them,
  whatever their names). A very long text is a row like others; a task holds its hashes, some 20 bytes for each of its letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrowtext import NOT_SPACE, buffers, hashes, mix, shingles, slices, words
from .components import components
from .shared import by_numbers, checked, drop_stored, packed, stored, tidy
from .sketch import band_keys, bands_for, sketch

ROWS, MISS = 4, 1e-7
#: Members of a block, and elements of their sets together, that a group holds about at most.
BLOCK, BLOCK_ELEMENTS = 1024, 1_000_000
#: Rounds of hubs before what is left is verified completely.
HUB_ROUNDS = 1
#: Ids of candidate classes (8 bytes each), and plans of groups, are broadcast up to so many; beyond, they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Elements of a group's comparison matrix held at a time.
MATRIX = 4 << 20


def _sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = buffers(column)
    w = words(raw, offsets, NOT_SPACE)
    return shingles(hashes(raw, w), w.first, k)


def _set_keys(keys: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(keys ^ np.uint64(salt)), dtype=np.uint64)])
        out.append(mix(total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
    return out[0], out[1]


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int, similarity: float) -> DataFrame:
    """For each row: id, n (size of its set), k1, k2 (hashes of the set), bands."""
    bands = bands_for(similarity, ROWS, MISS)
    source = checked(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                keys, offsets = _sets(part.column(1), k)
                k1, k2 = _set_keys(keys, offsets)
                b = band_keys(sketch(keys, offsets, bands * ROWS), ROWS).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1) * bands, pa.int32()), pa.array(b.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(offsets)), pa.array(k1), pa.array(k2), lists], names=["id", "n", "k1", "k2", "bands"])

    return source.mapInArrow(tidy(run), "id long, n long, k1 long, k2 long, bands array<long>")


def _small(stored_rows: DataFrame) -> DataFrame:
    """Marked for a broadcast if its rows are counted few."""
    return F.broadcast(stored_rows) if stored_rows.count() <= BROADCAST_ROWS else stored_rows


def _candidate_sets(docs: DataFrame, members: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Sets of the candidate classes, and of other texts with their ids: rep, k1, set (sorted 64-bit hashes)."""
    source = checked(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("rep"), F.col(f"`{text_col}`").alias("text"))
    wanted = stored(members.select("rep").distinct(), "candidates")
    source = source.join(_small(wanted), "rep", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                keys, offsets = _sets(part.column(1), k)
                k1, _ = _set_keys(keys, offsets)
                data = keys.tobytes()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(k1), pa.array([data[8 * a : 8 * b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())], names=["rep", "k1", "set"])

    return source.mapInArrow(tidy(run), "rep long, k1 long, set binary").dropDuplicates(["rep", "k1"])


def forest(left: list[np.ndarray], right: list[np.ndarray], names_left: np.ndarray, names_right: np.ndarray, comp_left: np.ndarray, comp_right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join what is linked between two lists of sets: a spanning forest of all pairs with 100 * intersection >= percent * union.

    Pairs in one component are skipped. Intersections are counted as products of 0/1 matrices over the shared elements.
    """
    sizes = [np.array([len(s) for s in side], np.int64) for side in (left, right)]
    flat_l, flat_r = (np.concatenate(side) if side else np.zeros(0, np.uint64) for side in (left, right))
    common = np.intersect1d(flat_l, flat_r)
    inside = []
    for flat, n in ((flat_l, sizes[0]), (flat_r, sizes[1])):
        at = np.minimum(np.searchsorted(common, flat), max(len(common) - 1, 0))
        ok = common[at] == flat if len(common) else np.zeros(len(flat), bool)
        inside.append((np.repeat(np.arange(len(n)), n)[ok], at[ok]))
    together = np.zeros((len(left), len(right)), np.float32)
    step = max(64, MATRIX // max(1, len(left) + len(right)))
    orders = [np.argsort(at, kind="stable") for _, at in inside]
    inside = [(row[o], at[o]) for (row, at), o in zip(inside, orders, strict=True)]
    for a in range(0, len(common), step):
        m = []
        for (row, at), n in zip(inside, (len(left), len(right)), strict=True):
            i, j = np.searchsorted(at, [a, a + step])
            x = np.zeros((n, min(step, len(common) - a)), np.float32)
            x[row[i:j], at[i:j] - a] = 1
            m.append(x)
        together += m[0] @ m[1].T
    both = together.astype(np.int64)
    union = sizes[0][:, None] + sizes[1][None, :] - both
    linked = 100 * both >= percent * union
    at_left, at_right = comp_left.copy(), comp_right.copy()  # components as they are joined here
    out = []
    for i in np.flatnonzero(linked.any(axis=1)):
        near = np.flatnonzero(linked[i])
        near = near[at_right[near] != at_left[i]]
        if len(near):
            others, first = np.unique(at_right[near], return_index=True)
            out += [(int(names_left[i]), int(x)) for x in names_right[near[first]]]
            mine = at_left[i]
            at_left[np.isin(at_left, others)] = mine
            at_right[np.isin(at_right, others)] = mine
    return out


def _verify(groups: DataFrame, percent: int) -> DataFrame:
    """groups: (g1, g2, g3, side, rep, comp, set), side 0 left, 1 right, 2 both. Links (a, b) between left and right of each group."""
    ordered = groups.select("g1", "g2", "g3", "side", "rep", "comp", "set").repartition("g1", "g2", "g3").sortWithinPartitions("g1", "g2", "g3")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def links():
            left, right = [r for r in rows if r[0] != 1], [r for r in rows if r[0] != 0]
            if not left or not right:
                return []
            get = lambda side, i: np.array([r[i] for r in side], np.int64)
            return forest([r[3] for r in left], [r[3] for r in right], get(left, 1), get(right, 1), get(left, 2), get(right, 2), percent)

        for batch in batches:
            found: list[tuple[int, int]] = []
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            more = zip(*(batch.column(i).to_pylist() for i in range(3, 6)), strict=True)
            sets = batch.column(6)
            for i, (key, (side, rep, comp)) in enumerate(zip(keys, more, strict=True)):
                if key != group:
                    found += links()
                    group, rows = key, []
                rows.append((side, rep, comp, np.frombuffer(sets[i].as_py(), np.uint64)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found]), pa.array([x[1] for x in found])], names=["a", "b"])
        found = links()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found]), pa.array([x[1] for x in found])], names=["a", "b"])

    return ordered.mapInArrow(tidy(run), "a long, b long")


def _buckets(classes: DataFrame) -> DataFrame:
    """Buckets of two classes or more, one of those with the same members: bucket, rep, k1, n."""
    every = classes.select(F.explode("bands").alias("bucket"), "rep", "k1", "n")
    return every.join(_kinds(every).select("bucket"), "bucket", "left_semi")


def _kinds(members: DataFrame, *more) -> DataFrame:
    """One bucket for each set of members."""
    each = members.groupBy("bucket").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("rep", "k1")).alias("x"), F.bit_xor(F.xxhash64("k1", "rep")).alias("y"), *more).filter("size > 1")
    return each.groupBy("size", "x", "y").agg(F.min("bucket").alias("bucket"), *[F.first(c).alias(c) for c in each.columns[4:]])


def _still_open(members: DataFrame, comps: DataFrame | None = None) -> DataFrame:
    """Members, with their component, of the buckets that hold several components."""
    if comps is not None:
        members = members.drop("comp").join(comps.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep")).drop("component")
    kinds = _kinds(members, F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    return members.join(kinds.select("bucket"), "bucket", "left_semi").select("bucket", "rep", "k1", "n", "comp")


def _block_count(rows: Column, elements: Column) -> Column:
    return F.greatest(F.ceil(rows / BLOCK), F.ceil(elements / BLOCK_ELEMENTS)).cast("int")


def _hub_round(members: DataFrame, sets: DataFrame, number: int, percent: int) -> DataFrame:
    """Links (a, b) of members (bucket, rep, k1, n, comp) to one hub each, in another component."""
    hubs = members.groupBy("bucket").agg(F.min(F.struct(F.xxhash64(F.lit(number), "rep", "k1").alias("o"), "rep", "k1", "comp")).alias("hub"))
    of = members.join(hubs, "bucket").filter("comp <> hub.comp").groupBy("rep", "k1", "comp").agg(F.min("hub").alias("hub"), F.first("n").alias("n"))
    pairs = of.select(F.col("hub.rep").alias("g1"), F.col("hub.k1").alias("g2"), F.col("hub.comp").alias("hub_comp"), "rep", "k1", "comp", "n")
    # a hub of very many members has several groups
    parts = pairs.groupBy("g1", "g2").agg(_block_count(F.count("*"), F.sum("n")).alias("nb"))
    right = pairs.join(parts, ["g1", "g2"]).withColumn("g3", F.pmod(F.xxhash64("rep", "k1"), F.col("nb")).cast("int"))
    left = right.select("g1", "g2", "g3", F.lit(0).alias("side"), F.col("g1").alias("rep"), F.col("g2").alias("k1"), F.col("hub_comp").alias("comp")).distinct()
    stars = left.unionByName(right.select("g1", "g2", "g3", F.lit(1).alias("side"), "rep", "k1", "comp"))
    return _verify(stars.join(sets, ["rep", "k1"]), percent)


def _hopeless(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Classes (rep, k1) that can link with no other: too many of their shingles are in no other class of ``members``."""
    alive = members.select("rep", "k1", "n").distinct()

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                raw, offsets = buffers(part.column(2))
                row = pa.array(np.repeat(np.arange(part.num_rows), np.diff(offsets) // 8))
                yield pa.RecordBatch.from_arrays([part.column(0).take(row), part.column(1).take(row), pa.array(np.frombuffer(raw.tobytes(), np.int64))], names=["rep", "k1", "e"])

    each = alive.join(sets, ["rep", "k1"]).select("rep", "k1", "set").mapInArrow(tidy(elements), "rep long, k1 long, e long")
    # of an element that one class holds, the least class is that class
    alone = each.groupBy("e").agg(F.count("*").alias("classes"), F.min("rep").alias("rep"), F.min("k1").alias("k1")).filter("classes = 1").groupBy("rep", "k1").agg(F.count("*").alias("alone"))
    # what is shared is n - alone at most, and the union n at least
    return alive.join(alone, ["rep", "k1"]).filter(100 * (F.col("n") - F.col("alone")) < percent * F.col("n")).select("rep", "k1")


def _plan(rows: DataFrame) -> DataFrame:
    """For groups (g, rep, k1, n, comp): their largest component, its blocks (bm), those of the others (bo), rows to send (cost)."""
    each = rows.groupBy("g", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    whole = each.groupBy("g").agg(F.max(F.struct("c", "comp", "s")).alias("m"), F.sum("c").alias("c"), F.sum("s").alias("s"))
    out = whole.select("g", F.col("m.comp").alias("main"), F.col("m.c").alias("mc"), (F.col("c") - F.col("m.c")).alias("oc"), _block_count(F.col("m.c"), F.col("m.s")).alias("bm"), _block_count(F.col("c") - F.col("m.c"), F.col("s") - F.col("m.s")).alias("bo"))
    return out.withColumn("cost", F.col("mc") * F.col("bo") + F.col("oc") * (F.col("bm") + F.col("bo")))


def _rest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join what is linked in the buckets of ``members``, in groups of buckets or bucket by bucket, whichever sends fewer rows."""
    least = members.groupBy("bucket").agg(F.min("rep").alias("least"))
    joined = stored(components(members.join(least, "bucket").select(F.col("rep").alias("a"), F.col("least").alias("b"))), "groups").withColumnRenamed("component", "whole")
    # a bucket of classes that share one rep has no link here; it is a group of its own
    placed = stored(members.join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn("whole", F.coalesce("whole", "rep")), "placed")
    by_bucket = placed.withColumn("g", F.col("bucket"))
    by_whole = placed.select("whole", F.col("whole").alias("g"), "rep", "k1", "n", "comp").distinct()
    plan_b, plan_w = stored(_plan(by_bucket), "plan"), stored(_plan(by_whole), "plan")
    costs = by_bucket.select("g", "whole").distinct().join(plan_b, "g").groupBy("whole").agg(F.sum("cost").alias("apart"))
    # a group may hold many rows, so plans travel to rows, if they are few
    together = _small(stored(costs.join(plan_w.select(F.col("g").alias("whole"), "cost"), "whole").filter("cost <= apart").select("whole"), "plan"))
    kinds = [(by_whole.join(together, "whole", "left_semi"), _small(plan_w), 0), (by_bucket.join(together, "whole", "left_anti"), _small(plan_b), 1)]
    groups = None
    for rows, plan, kind in kinds:
        rows = rows.join(plan, "g")
        main = F.col("comp") == F.col("main")
        rows = rows.withColumn("b", (F.pmod(F.xxhash64("rep", "k1", F.lit(1)), F.when(main, F.col("bm")).otherwise(F.col("bo"))) + F.when(main, F.col("bo")).otherwise(0)).cast("int"))
        rows = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("bo") - 1 + F.when(main, 0).otherwise(F.col("bm")))))
        pair = F.least("b", "j").cast("long") * F.lit(1 << 31) + F.greatest("b", "j")
        side = F.when(F.col("b") == F.col("j"), 2).when(F.col("b") < F.col("j"), 0).otherwise(1)
        rows = rows.select(F.col("g").alias("g1"), pair.alias("g2"), F.lit(kind).alias("g3"), side.alias("side"), "rep", "k1", "comp")
        groups = rows if groups is None else groups.unionByName(rows)
    return _verify(groups.join(sets, ["rep", "k1"]), percent)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """For each row: id, n_shingles, component_id, kept. Links need 100 * intersection >= percent * union."""
    return by_numbers(checked(docs, id_col, text_col), id_col, lambda rows: _near_duplicates(rows, id_col, text_col, k, percent), "component_id")


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    sig = stored(signatures(docs, id_col, text_col, k, percent / 100), "signatures")
    # stored, so that the join of rows to classes has plain exchanges on both sides and a class of very many copies is split
    classes = stored(sig.filter("n > 0 AND id IS NOT NULL").groupBy("n", "k1", "k2").agg(F.min("id").alias("rep"), F.first("bands").alias("bands")), "classes")
    # before the first round, each class is a component of its own
    members = stored(_buckets(classes).withColumn("comp", F.xxhash64("rep", "k1")), "buckets")
    sets = stored(_candidate_sets(docs, members, id_col, text_col, k), "sets")
    found, done = None, [members, sets]
    for number in range(HUB_ROUNDS):
        links = stored(_hub_round(members, sets, number, percent), "stars")
        found = links if found is None else found.unionByName(links)
        comps = stored(components(found), "components")
        members = stored(_still_open(members, comps), "open")
        done += [comps, members]
    left = stored(_still_open(members.join(_hopeless(members, sets, percent), ["rep", "k1"], "left_anti")), "open")
    rest = stored(_rest(left, sets, percent), "rest") if left.limit(1).count() else spark.createDataFrame([], "a long, b long")

    named = classes.select("n", "k1", "k2", "rep")
    # an id with several texts links the classes of these
    twice = sig.filter("n > 0 AND id IS NOT NULL").groupBy("id").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).filter("lo <> hi")
    same_id = sig.join(twice.select("id"), "id").join(named, ["n", "k1", "k2"]).select(F.col("id").alias("a"), F.col("rep").alias("b"))
    final = stored(components(found.unionByName(rest).unionByName(same_id)), "components")

    out = (
        sig.select("id", "n", "k1", "k2")
        .join(named, ["n", "k1", "k2"], "left")
        .join(final.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id")))
        .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", (F.col("id").isNull() | (F.col("id") == F.col("component_id"))).alias("kept"))
    )
    drop_stored(spark, *done, left)
    return out


def near_deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller id; all columns are kept."""
    gone = near_duplicates(docs, id_col, text_col, k, percent).filter(~F.col("kept")).select(F.col(f"`{id_col}`").alias("_gone")).distinct()
    return packed(docs, _id=F.col(f"`{id_col}`")).join(gone, F.col("_id") == F.col("_gone"), "left_anti").select("_row.*")
