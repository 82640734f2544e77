"""The trie of conversation prefixes, by van Emde Boas recursion.

A trie of depth D is cut at half its depth. The prefixes that end at the cut are named (by the smallest conversation that has
them); the upper trie is built from one row for each name and the sequences that end above the cut, the lower forests from what
is left of each sequence below the cut, under the name it hangs from. Both are cut again in the same way. All tries and
forests of one step of the recursion are one Spark job, so a trie of depth D takes about log2(D) steps of an aggregation and a
join, and a prefix that a third of all conversations share is one row from the first cut above it on. A trie one level deep is a
list of nodes: each name is a node, and the name it hangs from is its parent.

Members of a node are counted where it is named: a row of an upper trie weighs as many conversations as it stands for. Sums
over subtrees (childless nodes, saved tokens) are grafted upward: in the order of the cuts, the values of the nodes of each lower
forest are added to the node at the cut that it hangs from, where they belong to the upper trie and take part in its own cuts.
Each step is one aggregation over nodes.

The digest of the conversations that end at a node takes them in order, and a node may hold a large part of all. They are
range-partitioned by node and conversation, each task joins what it has of a node to pieces of text, and only these
pieces come together, one after another, in the task that digests the node.

Defined results
* turns are ordered by turn (null first), then role, then the hash of role and text; repeated rows are turns of their own. Null role or text is empty.
* rows with a null conversation id take no part; sequences that share an id are not allowed (``sequences`` makes one each).
* a conversation without turns is a member of the root and ends there. Without any conversation there is no node.
* turns are compared by 128-bit hashes of role and text. Very long texts and sequences are rows like others; a sequence is one row,
  with 32 letters and a count for each turn. Other columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checked, drop_stored, stored

#: Letters of conversation ids in a piece of a digest.
PIECE = 1 << 20


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: conv_id, turns (array of symbol, words, in order). Only hashes of texts are shuffled."""
    said, told = F.coalesce(F.col(f"`{role}`"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    symbol = F.md5(F.concat(F.length(said).cast("string"), F.lit(":"), said, told).cast("binary"))
    words = F.size(F.regexp_extract_all(told, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).cast("long")
    rows = checked(turns, conv, turn, role, text).select(F.col(f"`{conv}`").cast("long").alias("conv_id"), F.struct(F.col(f"`{turn}`").alias("turn"), said.alias("role"), symbol.alias("symbol"), words.alias("words")).alias("x"))
    convs = rows.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return convs.select("conv_id", F.transform("x", lambda t: F.struct(t["symbol"].alias("symbol"), t["words"].alias("words"))).alias("turns"))


def _cut_names(rows: DataFrame, steps: list) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One step of the recursion over rows of all tries: nodes of tries of one level, ends at the cut, and the rows of the halves.

    rows: lo, hi (the levels of the row's trie), root (the name it hangs from), conv, weight, own (whether conv ends at ``n``, not only
    its prefix), n (the level where the row ends), symbols and words (below lo), cuts (level and name of the cut above, for each step).
    """
    flat = F.col("hi") - F.col("lo") == 1
    rows = rows.withColumn("cut", F.when(flat, F.col("hi")).otherwise(((F.col("lo") + F.col("hi")) / 2).cast("int")))
    width = F.col("cut") - F.col("lo")
    deep = rows.filter("n >= cut").withColumn("part", F.md5(F.array_join(F.slice("symbols", F.lit(1), width), "").cast("binary")))
    # stored, so that the join has plain exchanges on both sides and a name that very many rows share is split
    names = stored(deep.groupBy("lo", "hi", "root", "part").agg(F.min("conv").alias("name"), F.sum("weight").alias("members")), "names")
    named = stored(deep.join(names, ["lo", "hi", "root", "part"]), "named")
    steps += [names, named]
    nodes = named.filter(flat & (F.col("conv") == F.col("name")))
    ends = named.filter("own AND n = cut").select(F.col("cut").alias("depth"), "name", "conv")
    none = F.lit(None).cast("struct<depth:int,name:long>")
    half = ["lo", "hi", "root", "conv", "weight", "own", "n", "symbols", "words", "cuts"]
    above = rows.filter("n < cut").withColumn("hi", F.col("cut"))
    short = named.filter(~flat & (F.col("conv") == F.col("name"))).withColumns(
        {"symbols": F.slice("symbols", F.lit(1), width), "words": F.slice("words", F.lit(1), width), "weight": F.col("members"), "own": F.lit(False), "n": F.col("cut"), "hi": F.col("cut")}
    )
    upper = above.unionByName(short.select(*above.columns)).withColumn("cuts", F.concat("cuts", F.array(none))).select(*half)
    rest = F.col("n") - F.col("cut")
    lower = (
        named.filter(~flat & (F.col("n") > F.col("cut")))
        .withColumns({"symbols": F.slice("symbols", width + 1, rest), "words": F.slice("words", width + 1, rest), "cuts": F.concat("cuts", F.array(F.struct(F.col("cut").alias("depth"), "name")))})
        .withColumns({"root": F.col("name"), "lo": F.col("cut")})
        .select(*half)
    )
    return nodes, ends, upper.unionByName(lower)


def _with_sums(nodes: DataFrame, step: int) -> DataFrame:
    """Values of the lower forests of a step added to the nodes at its cuts."""
    cut = F.get("cuts", F.lit(step))
    grafts = nodes.filter(cut.isNotNull()).groupBy(cut["depth"].alias("depth"), cut["name"].alias("name")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    out = nodes.join(grafts, ["depth", "name"], "left")
    return out.withColumns({"leaves": F.col("leaves") + F.coalesce("more_leaves", F.lit(0)), "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0))}).drop("more_leaves", "more_saved")


def _end_digests(ends: DataFrame) -> DataFrame:
    """For each node (depth, name) where conversations end: ends_sha256 of their ids, ascending, comma-joined."""
    order = ["depth", "name", "conv"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, None, [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int32()), pa.array([node[1]]), pa.array([first]), pa.array([",".join(ids)])], names=["depth", "name", "first", "ids"])

        for batch in batches:
            for depth, name, conv in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (depth, name) != node or size > PIECE:
                    if ids:
                        yield out()
                    node, first, ids, size = (depth, name), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
        if ids:
            yield out()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int32()), pa.array([node[1]]), pa.array([sha.hexdigest()])], names=["depth", "name", "ends_sha256"])

        for batch in batches:
            for depth, name, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if (depth, name) == node:
                    sha.update(b"," + ids.encode())
                    continue
                if node is not None:
                    yield out()
                node, sha = (depth, name), hashlib.sha256(ids.encode())
        if node is not None:
            yield out()

    parts = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, "depth int, name long, first long, ids string")
    return parts.repartition("depth", "name").sortWithinPartitions("depth", "name", "first").mapInArrow(digests, "depth int, name long, ends_sha256 string")


def prefix_trie(convs: DataFrame) -> DataFrame:
    """From sequences (conv_id, turns): one row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    steps: list[DataFrame] = []
    every = stored(checked(convs, "conv_id", "turns").select(F.col("conv_id").alias("conv"), F.size("turns").alias("n"), F.col("turns.symbol").alias("symbols"), F.col("turns.words").alias("words")), "sequences")
    steps.append(every)
    top = every.agg(F.min("conv").alias("name"), F.count("*").alias("n"), F.max("n").alias("depth")).first()
    first = F.lit(top.name).cast("long")
    ends = every.filter("n = 0").select(F.lit(0).alias("depth"), first.alias("name"), "conv")
    nodes, levels = None, 0
    depth = top.depth or 0
    if depth:
        rows = every.filter("n > 0").select(F.lit(0).alias("lo"), F.lit(depth).alias("hi"), first.alias("root"), "conv", F.lit(1).cast("long").alias("weight"), F.lit(True).alias("own"), "n", "symbols", "words", F.array().cast("array<struct<depth:int,name:long>>").alias("cuts"))
        while True:
            found, at_cut, halves = _cut_names(rows, steps)
            found = found.select(F.col("cut").alias("depth"), "name", F.col("root").alias("parent"), F.col("members").alias("n_convs"), F.get("words", F.lit(0)).alias("n_words"), "cuts")
            nodes = found if nodes is None else nodes.unionByName(found)
            ends = ends.unionByName(at_cut)
            if depth <= 1 << levels:  # every trie of this step has one level
                break
            rows = stored(halves, "halves")
            steps.append(rows)
            levels += 1
        nodes = stored(nodes, "nodes")
        children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
        nodes = nodes.join(children, ["depth", "name"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
        nodes = stored(nodes.withColumns({"leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("n_words")}), "nodes")
        for step in range(levels):
            nodes, last = stored(_with_sums(nodes, step), "nodes"), nodes
            steps.append(last)
        root = nodes.filter("depth = 1").agg(F.count("*").alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    else:
        root = convs.sparkSession.range(1).select(F.lit(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    root = root.select(F.lit(0).alias("depth"), first.alias("name"), F.lit(None).cast("long").alias("parent"), F.lit(top.n).cast("long").alias("n_convs"), "n_children", "leaves", "saved").filter(F.lit(top.n > 0))
    whole = root if nodes is None else nodes.select(*root.columns).unionByName(root)
    digests = stored(_end_digests(ends), "digests")
    drop_stored(convs.sparkSession, *steps)
    none = hashlib.sha256(b"").hexdigest()
    return whole.join(digests, ["depth", "name"], "left").select(
        F.col("name").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")
    )
