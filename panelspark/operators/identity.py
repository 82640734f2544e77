"""Resolving names to a catalog in stages: exact, alias, suffix, words in common, similarity.

Each stage works on the distinct names that no stage before matched, inside a block (a state), so a name is scored once and
only against candidates of its block. Candidates of the last stages come from equi-joins on what a match must share:
words of which one name's are all among the other's share the rarest of the smaller set, and names of a sequence ratio share one
of their rarest pairs of letters (or letters, where names are short). The ratio itself, which Spark lacks, is worked out in
Arrow batches for what is left.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from panelspark.sources.files import stored

#: Scores below which a stage doesn't match, that of a name without its suffix, those of hints, and the suffixes; fixed values.
LEAST_WORDS, LEAST_RATIO, SUFFIX_SCORE, LEAST_HINT = 0.5, 0.85, 0.95, 0.55
#: Names, and pairs of them, that a task remembers; results don't depend on it.
REMEMBERED = 1 << 16
SUFFIXES = ("_de", "_del", "_la", "_el", "_las", "_los")


def similarity(pairs: DataFrame, a: str, b: str, name: str = "ratio") -> DataFrame:
    """Adds the Ratcliff-Obershelp ratio of two columns. A pair of names that several blocks have is worked out once in a task."""
    cols = pairs.columns
    schema = StructType([*pairs.schema.fields, StructField(name, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from difflib import SequenceMatcher
        from functools import lru_cache

        ratio = lru_cache(REMEMBERED)(lambda p, q: None if p is None or q is None else SequenceMatcher(None, p, q).ratio())
        for batch in batches:
            r = list(map(ratio, batch.column(cols.index(a)).to_pylist(), batch.column(cols.index(b)).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(r, pa.float64())], names=[*cols, name])

    return pairs.mapInArrow(run, schema)


def letters_fit(pairs: DataFrame, a: str, b: str, least: float) -> DataFrame:
    """Pairs whose sequence ratio may be ``least`` or more, by the letters that both have: no more than these can match.

    In Arrow batches, so that it runs once for each pair where the optimizer would move an expression before the step that makes pairs distinct.
    """
    cols = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from functools import lru_cache

        letters = lru_cache(REMEMBERED)(lambda x: frozenset((c, i) for c, n in Counter(x).items() for i in range(n)))
        for batch in batches:
            x, y = batch.column(cols.index(a)).to_pylist(), batch.column(cols.index(b)).to_pylist()
            yield batch.filter(pa.array([2 * len(letters(p) & letters(q)) >= least * (len(p) + len(q)) - 1e-9 for p, q in zip(x, y, strict=True)], pa.bool_()))

    return pairs.mapInArrow(run, pairs.schema)


def words_contained(a: Column, b: Column) -> Column:
    """Whether one name's words are all among the other's."""
    x, y = F.split(a, "_"), F.split(b, "_")
    return (F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0)


def grams(c: Column, n: int) -> Column:
    """Runs of ``n`` letters of a text, each with its number among equal ones: a set as large as the text has runs."""
    runs = F.transform(F.when(F.length(c) >= n, F.sequence(F.lit(1), F.length(c) - n + 1)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(c, i, F.lit(n)))
    return F.transform(runs, lambda x, i: F.concat(x, F.lit("\t"), F.size(F.filter(F.slice(runs, F.lit(1), i), lambda y: y == x)).cast("string")))


def rarest(df: DataFrame, keys: list[str], block: str, tokens: str, keep: Column, often: DataFrame) -> DataFrame:
    """keys and _t: of each row's tokens the ``keep`` rarest in its block, by ``often`` (block, _t, _n); unknown ones are the rarest."""
    each = df.select(*keys, keep.alias("_keep"), F.explode(tokens).alias("_t")).join(often, [block, "_t"], "left")
    order = F.sort_array(F.collect_list(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_t")))
    return each.groupBy(*keys).agg(order.alias("_o"), F.first("_keep").alias("_keep")).select(*keys, F.explode(F.slice("_o", F.lit(1), F.col("_keep").cast("int"))).alias("_o")).select(*keys, F.col("_o._t").alias("_t"))


def _frequencies(df: DataFrame, block: str, tokens: Column) -> DataFrame:
    return df.select(block, F.explode(tokens).alias("_t")).groupBy(block, "_t").agg(F.count("*").alias("_n"))


def contained_pairs(names: DataFrame, catalog: DataFrame, block: str, a: str, b: str) -> DataFrame:
    """Pairs (block, a, b) of one block where the words of one are all among the other's. Each side's rarest word must be a word of the other."""
    split = lambda c: F.array_distinct(F.split(c, "_"))
    often = _frequencies(catalog, block, split(b))
    words = lambda df, c: df.select(block, c, split(c).alias("_w"))
    one = lambda df, c: rarest(words(df, c), [block, c], block, "_w", F.lit(1), often)
    every = lambda df, c: words(df, c).select(block, c, F.explode("_w").alias("_t"))
    pairs = one(names, a).join(every(catalog, b), [block, "_t"]).unionByName(every(names, a).join(one(catalog, b), [block, "_t"]))
    return pairs.select(block, a, b).distinct().filter(words_contained(F.col(a), F.col(b)))


def alike_pairs(names: DataFrame, catalog: DataFrame, block: str, a: str, b: str, least: float) -> DataFrame:
    """Pairs (block, a, b) of one block that may have a sequence ratio of ``least`` or more; no such pair is missed.

    With M letters in matching runs, the ratio is 2M / T, T the letters of both. Runs are at most one more than the letters left over, so the
    pair shares 3M - T - 1 pairs of letters or more, and M letters. As sets of n tokens that share k, both hold one of the shared tokens among their
    n - k + 1 rarest. Lengths bound k: with a ratio of r, the shorter has r / (2 - r) of the longer at least.
    """
    share, gain = least / (2 - least), 1.5 * least - 1
    few = 2 / gain if gain > 0 else float("inf")  # below it in sum, two names may share no pair of letters

    def tokens(df: DataFrame, c: str, often: DataFrame | None, n: int) -> DataFrame:
        size = F.length(c)
        rows = df.select(block, c, grams(F.col(c), n).alias("_g"))
        if n == 1:
            rows = rows.filter(size * (1 + share) < few)
            shared = F.ceil(size * share - 1e-9)
        else:
            shared = F.ceil(gain * size * (1 + share) - 1 - 1e-9)
        keep = F.size("_g") - F.greatest(shared, F.lit(1)) + 1
        return rarest(rows, [block, c], block, "_g", keep, often)

    pairs = None
    for n in (1, 2) if gain > 0 else (1,):
        often = _frequencies(catalog, block, grams(F.col(b), n))
        found = tokens(names, a, often, n).join(tokens(catalog, b, often, n), [block, "_t"]).select(block, a, b)
        pairs = found if pairs is None else pairs.unionByName(found)
    total = F.length(a) + F.length(b)
    fits = 2 * F.least(F.length(a), F.length(b)) >= least * total - 1e-9
    return letters_fit(pairs.filter(fits).distinct(), a, b, least)


def match_names(names: DataFrame, catalog: DataFrame, block: str, name: str, key: str, aliases: DataFrame | None = None, suffixes: tuple[str, ...] = SUFFIXES, by_ratio: bool = True, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """For each distinct (block, name): key, score, stage. names and catalog hold slugs; aliases: block, name, key.

    Names whose words contain the catalog's, or the reverse, and names that are only alike are scored by their sequence ratio;
    of equal scores the least catalog name is taken.
    """
    # stored, since every stage reads them, and what makes a slug may cost more than the stages do
    todo = stored(names.select(block, name).distinct(), "names")
    cat = stored(catalog.groupBy(block, F.col(name).alias("_slug")).agg(F.min(key).alias(key)), "catalog")

    def best(found: DataFrame) -> DataFrame:
        """The first stage that matches a name, its best score, the least catalog name."""
        order = F.struct("_order", -F.col("score"), F.col("_slug"))
        return found.groupBy(block, name).agg(F.min_by(F.struct(key, "score", "stage"), order).alias("_m")).select(block, name, "_m.*")

    def stage(df: DataFrame, number: Column, label: str, score: Column) -> DataFrame:
        return df.select(block, name, "_slug", key, score.cast("double").alias("score"), F.lit(label).alias("stage"), number.alias("_order"))

    # stages that are plain equi-joins, in one pass
    ends = F.array(*[F.when(F.endswith(name, F.lit(x)), F.struct(F.lit(i).alias("_i"), F.substring(name, F.lit(1), F.length(name) - len(x)).alias("_slug"))) for i, x in enumerate(suffixes)])
    cut = todo.withColumn("_e", F.explode(F.array_compact(ends))).select(block, name, "_e.*")
    plain = stage(todo.withColumn("_slug", F.col(name)).join(cat, [block, "_slug"]), F.lit(0), "exact", F.lit(1.0))
    plain = plain.unionByName(stage(cut.join(cat, [block, "_slug"]), F.lit(2) + F.col("_i"), "suffix", F.lit(SUFFIX_SCORE)))
    if aliases is not None:
        plain = plain.unionByName(stage(todo.join(aliases.select(block, name, key), [block, name]).withColumn("_slug", F.col(name)), F.lit(1), "alias", F.lit(1.0)))
    found = stored(best(plain), "plain-names")
    rest = stored(todo.join(found.select(block, name), [block, name], "left_anti").filter(F.length(name) > 0), "other-names")
    # candidates of both stages are scored in one pass; the words of a name come before its letters
    pairs = contained_pairs(rest, cat, block, name, "_slug").withColumn("_order", F.lit(10))
    if by_ratio:
        pairs = pairs.unionByName(alike_pairs(rest, cat, block, name, "_slug", least_ratio).withColumn("_order", F.lit(11)))
    scored = similarity(pairs, name, "_slug").filter(F.col("ratio") >= F.when(F.col("_order") == 10, LEAST_WORDS).otherwise(least_ratio))
    later = scored.join(cat, [block, "_slug"]).select(block, name, "_slug", key, F.col("ratio").alias("score"), F.when(F.col("_order") == 10, "words").otherwise("ratio").alias("stage"), "_order")
    done = found.unionByName(best(later))
    return todo.join(done, [block, name], "left").select(block, name, key, F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("stage", F.lit("none")).alias("stage"))


def with_floor(matches: DataFrame, key: str, floor: float = 0.85) -> DataFrame:
    """Keys as text; those of matches under the floor become empty."""
    return matches.withColumn(key, F.when(F.col("score") >= floor, F.col(key).cast("string")).otherwise(F.lit("")))


def hints(names: DataFrame, catalog: DataFrame, block: str, name: str, key: str, cell: list[str], aliases: DataFrame | None = None) -> DataFrame:
    """Names of unknown identity as hints for cells (key, and the columns ``cell`` of names): the best name of each, its score and verdict."""
    found = match_names(names, catalog, block, name, key, aliases, least_ratio=LEAST_HINT).filter(F.col(key).isNotNull() & (F.col("score") >= LEAST_HINT))
    best = names.join(found, [block, name]).groupBy(block, key, *cell).agg(F.max_by(F.struct(name, "score"), F.struct("score", name)).alias("_m"))
    return best.select(block, key, *cell, f"_m.{name}", F.col("_m.score").alias("score"), verdict(F.col("_m.score")).alias("verdict"))


def verdict(score: Column) -> Column:
    return F.when(score >= 0.85, "match").when(score >= 0.60, "hint").otherwise("none")
