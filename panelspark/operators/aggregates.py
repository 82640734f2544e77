"""Summaries: distributions, crosstabs, coverage, prevalence, cohorts, usage of identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def distribution(df: DataFrame, column: str, categories: list[str], digits: int = 2) -> DataFrame:
    """Count and percent of each category, in the order given, zeros included."""
    spark = df.sparkSession
    base = spark.createDataFrame([(i, c) for i, c in enumerate(categories)], f"position long, {column} string")
    n = df.groupBy(column).agg(F.count("*").alias("n"))
    out = base.join(n, column, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.sum("n").over(Window.partitionBy())
    return out.withColumn("pct", F.when(total > 0, F.round(100 * F.col("n") / total, digits)).otherwise(F.lit(0.0)))


def crosstab(df: DataFrame, row: str, column: str, categories: list[str]) -> DataFrame:
    """Counts by row and column with a total; categories are given, so one pass is enough."""
    out = df.groupBy(row).agg(*[F.count_if(F.col(column) == c).alias(c) for c in categories])
    return out.withColumn("total", sum((F.col(f"`{c}`") for c in categories), F.lit(0).cast("long")))


def spread(df: DataFrame, by: str, entity: str, year: str) -> DataFrame:
    """Rows, entities, first, last and number of years of each group."""
    return df.groupBy(by).agg(F.count("*").alias("n"), F.countDistinct(entity).alias("entities"), F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.countDistinct(year).alias("years"))


def missing_years(df: DataFrame, years: tuple[int, int], entity: str = "entity", year: str = "year") -> DataFrame:
    """Years of the window that an entity lacks, as a number and a list."""
    seen = df.groupBy(entity).agg(F.collect_set(F.col(year).cast("int")).alias("_y"))
    gone = F.array_except(F.sequence(F.lit(years[0]), F.lit(years[1])), "_y")
    return seen.select(entity, F.size(F.array_intersect("_y", F.sequence(F.lit(years[0]), F.lit(years[1])))).cast("long").alias("n_years"), F.size(gone).cast("long").alias("n_missing"), F.array_join(F.transform(gone, lambda y: y.cast("string")), ";").alias("years_missing"))


def z_scores(df: DataFrame, by: list[str], value: str, least_n: int = 4, least_sd: float = 0.0) -> DataFrame:
    """Rows with n, mean and sample deviation of their cohort and the z-score; cohorts under the floors give none.

    Cohorts are pre-aggregated and joined back, so a cohort with a third of all rows isn't gathered in a task.
    """
    s = df.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    return df.join(s, by).filter((F.col("n") >= least_n) & (F.col("sd") > 0) & (F.col("sd") >= least_sd)).withColumn("z", (F.col(value) - F.col("mean")) / F.col("sd"))


def identifier_usage(df: DataFrame, key: str, entity: str, year: str, value: str, most: int = 5) -> DataFrame:
    """Uses, entities and years of an identifier, and its ``most`` least different values."""
    n = df.groupBy(key).agg(F.count("*").alias("n"), F.countDistinct(entity).alias("entities"), F.countDistinct(year).alias("years"))
    firsts = df.select(key, value).distinct().withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(value))).filter(F.col("_r") <= most)
    shown = firsts.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(value)), lambda v: v.cast("string")), "|").alias("samples"))
    return n.join(shown, key, "left")


def fragmentation(df: DataFrame, group: str, key: str, top: int) -> DataFrame:
    """The groups with the most different keys."""
    return df.groupBy(group).agg(F.countDistinct(key).alias("keys")).orderBy(F.desc("keys"), group).limit(top)


def concept_overlap(df: DataFrame, text: str, group: str, concepts: dict[str, list[str]]) -> DataFrame:
    """For each concept (all its substrings in a text) the rows and groups in which it is found."""
    hits = [F.when(_all_in(F.lower(F.col(text)), parts), F.lit(name)) for name, parts in concepts.items()]
    x = df.select(group, F.explode(F.array_compact(F.array(*hits))).alias("concept"))
    return x.groupBy("concept").agg(F.count("*").alias("n"), F.countDistinct(group).alias("groups"))


def _all_in(c: Column, parts: list[str]) -> Column:
    out = F.lit(True)
    for p in parts:
        out = out & c.contains(p)
    return out


def prevalence(df: DataFrame, detectors: dict[str, tuple[Column, Column]]) -> DataFrame:
    """For each detector (applies, fires): rows to which it applies, rows on which it fires, percent. One pass."""
    parts = [F.struct(F.lit(n).alias("detector"), F.count_if(applies).alias("denominator"), F.count_if(applies & fires).alias("cases")) for n, (applies, fires) in detectors.items()]
    x = df.agg(F.array(*parts).alias("_a")).select(F.inline("_a"))
    return x.withColumn("pct", F.when(F.col("denominator") > 0, F.round(100 * F.col("cases") / F.col("denominator"), 4)).otherwise(F.lit(0.0)))


def issue_histogram(df: DataFrame, issues: str, sep: str = "; ") -> DataFrame:
    """How often each issue of a delimited list is found; what follows a colon in an issue is left out."""
    x = df.filter(F.coalesce(F.col(issues), F.lit("")) != "").select(F.explode(F.split(F.col(issues), sep)).alias("issue"))
    return x.select(F.trim(F.regexp_replace("issue", ":.*$", "")).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))


def fallback_rate(df: DataFrame, by: str, is_fallback: Column) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n"), F.count_if(is_fallback).alias("fallbacks")).withColumn("pct", F.round(100 * F.col("fallbacks") / F.col("n"), 4))


def regimes(df: DataFrame, document: str, member: str) -> DataFrame:
    """A for documents with one member, B for more."""
    return df.groupBy(document).agg(F.countDistinct(member).alias("members")).withColumn("regime", F.when(F.col("members") > 1, "B").otherwise("A"))


def changed_entities(df: DataFrame, changed: Column, entity: str) -> DataFrame:
    """Whether an entity ever changed."""
    return df.groupBy(entity).agg(F.bool_or(F.coalesce(changed, F.lit(False))).alias("changed"))


def best_row(df: DataFrame, by: list[str], score: Column, ties: list[str]) -> DataFrame:
    """The row with the largest score of each group; ties go to the least of the columns named. A map-side maximum."""
    rest = [c for c in df.columns if c not in by]
    rank = F.struct((-score).alias("s"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)])
    return df.groupBy(*by).agg(F.min_by(F.struct(*rest), rank).alias("_r")).select(*by, "_r.*")


def stratified_sample(df: DataFrame, stratum: str, key: str, k: int, seed: int = 7, priority: Column | None = None) -> DataFrame:
    """``k`` rows of each stratum in the order of a priority and a hash of the key, the same at every run."""
    draw = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    order = ([priority] if priority is not None else []) + [draw, F.col(key)]
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy(*order))).filter(F.col("_r") <= k).drop("_r")


def page(df: DataFrame, order: list[Column], number: int, size: int, most: int = 200) -> DataFrame:
    """A page of an ordered result; number and size are clamped."""
    size = max(1, min(size, most))
    return df.orderBy(*order).offset((max(1, number) - 1) * size).limit(size)
