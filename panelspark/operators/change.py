"""Comparing an entity's consecutive observed rows, and reading its trajectory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.nested import trajectory, trajectory_pattern


def with_previous(df: DataFrame, columns: list[str], entity: str = "entity", year: str = "year") -> DataFrame:
    """Adds prev_<column> from the row before, by year; rows, not years, are consecutive."""
    w = Window.partitionBy(entity).orderBy(year)
    return df.withColumns({f"prev_{c}": F.lag(c).over(w) for c in [year, *columns]})


def change_flags(df: DataFrame, kind: str, rate: str, count: str, entity: str = "entity", year: str = "year", step: float = 0.001, jump: float = 0.5) -> DataFrame:
    """rate_changed (by more than ``step`` of the rate before), schema_changed, count_changed, and flag_anomaly (a jump)."""
    x = with_previous(df, [kind, rate, count], entity, year)
    relative = F.when(F.col(f"prev_{rate}") > 0, F.abs(F.col(rate) - F.col(f"prev_{rate}")) / F.col(f"prev_{rate}"))
    no = lambda c: F.coalesce(c, F.lit(False))
    return x.select(
        *df.columns,
        no(relative > step).alias("rate_changed"),
        no(F.col(kind) != F.col(f"prev_{kind}")).alias("schema_changed"),
        no(F.col(count) != F.col(f"prev_{count}")).alias("count_changed"),
        no(relative > jump).alias("flag_anomaly"),
    )


def switches(df: DataFrame, kind: str, entity: str = "entity", year: str = "year", unknown: str = "") -> DataFrame:
    """Rows whose kind differs from the one before, both known: entity, year, from_kind, to_kind."""
    x = with_previous(df, [kind], entity, year)
    known = (F.col(kind) != unknown) & (F.col(f"prev_{kind}") != unknown)
    return x.filter(known & (F.col(kind) != F.col(f"prev_{kind}"))).select(entity, year, F.col(f"prev_{kind}").alias("from_kind"), F.col(kind).alias("to_kind"))


def count_jumps(df: DataFrame, count: str, kind: str, entity: str = "entity", year: str = "year") -> DataFrame:
    """Counts that more than double or fall under half, both above 0, and unstable ones (by more than 2 within a kind)."""
    x = with_previous(df, [count, kind], entity, year)
    c, p = F.col(count), F.col(f"prev_{count}")
    ratio = F.when((c > 0) & (p > 0), c / p)
    return x.filter(F.col(f"prev_{year}").isNotNull()).select(entity, year, F.coalesce((ratio > 2) | (ratio < 0.5), F.lit(False)).alias("jump"), F.coalesce((F.abs(c - p) > 2) & (F.col(kind) == F.col(f"prev_{kind}")), F.lit(False)).alias("unstable"))


def stable_runs(df: DataFrame, changed: Column, entity: str = "entity", year: str = "year") -> DataFrame:
    """At each change, how many transitions before it went without one."""
    w = Window.partitionBy(entity).orderBy(year)
    x = df.withColumn("_n", F.row_number().over(w)).withColumn("_c", F.when(F.col("_n") > 1, F.coalesce(changed, F.lit(False)).cast("int")))
    x = x.withColumn("_island", F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    x = x.withColumn("run", F.sum(F.when(F.col("_c") == 0, 1).otherwise(0)).over(Window.partitionBy(entity, "_island").orderBy(year)))
    return x.filter("_c = 1").select(entity, year, F.col("run").cast("long").alias("stable_run"))


def outliers(df: DataFrame, status: str, entity: str = "entity", year: str = "year") -> DataFrame:
    """Adds is_outlier: the row differs from both neighbours, which agree."""
    w = Window.partitionBy(entity).orderBy(year)
    before, after = F.lag(status).over(w), F.lead(status).over(w)
    return df.withColumn("is_outlier", F.coalesce((before == after) & (before != F.col(status)), F.lit(False)))


def trajectories(df: DataFrame, status: str, years: tuple[int, int], entity: str = "entity", year: str = "year") -> DataFrame:
    """entity, seq (a mark for each year, · for none), observed (marks of observed years) and pattern of these."""
    marks = F.map_from_entries(F.collect_list(F.struct(F.col(year).cast("int"), F.col(status))))
    order = F.array_sort(F.collect_list(F.struct(year, status)))
    x = df.groupBy(entity).agg(marks.alias("_m"), F.array_join(F.transform(order, lambda r: r[status]), "").alias("observed"))
    return x.select(entity, trajectory(years, F.col("_m")).alias("seq"), "observed", trajectory_pattern(F.col("observed")).alias("pattern"))


def anomalous_years(df: DataFrame, status: str, entity: str = "entity", year: str = "year") -> DataFrame:
    """Rows of unusual trajectories: one-year outliers, the tail after the last T of a reversion, minority blocks of flips."""
    x = outliers(df, status, entity, year)
    w = Window.partitionBy(entity)
    clean = F.when(~F.col("is_outlier"), F.struct(F.col(year).alias("y"), F.col(status).alias("s")))
    x = x.withColumn("_clean", F.array_sort(F.collect_list(clean).over(w)))
    pattern = trajectory_pattern(F.array_join(F.transform("_clean", lambda r: r["s"]), ""))
    n_t = F.size(F.filter("_clean", lambda r: r["s"] == "T"))
    last_t = F.array_max(F.transform(F.filter("_clean", lambda r: r["s"] == "T"), lambda r: r["y"]))
    minority = F.when(n_t <= F.size("_clean") - n_t, "T").otherwise("C")
    s = F.col(status)
    other = lambda c: F.when(c == "T", "C").otherwise("T")
    x = x.withColumns({"_p": pattern, "_last_t": last_t, "_minor": minority})
    why = (
        F.when(F.col("is_outlier"), F.concat(F.lit("outlier_"), s, F.lit("_in_"), other(s)))
        .when(F.col("_p").isin("siempre_T", "siempre_C", "clean_onset"), F.lit(None))
        .when(F.col("_p") == "reversion_simple", F.when((F.col(year) > F.col("_last_t")) & (s == "C"), "reversion_T_to_C"))
        .when(s == F.col("_minor"), F.concat(F.lit("flip_minority_block_"), s, F.lit("_in_majority_"), other(s)))
    )
    return x.withColumn("reason", why).filter("reason IS NOT NULL").select(entity, year, "reason", F.when(F.col("reason") == "reversion_T_to_C", "T").otherwise(other(s)).alias("expected"))


def event_study(cells: DataFrame, arm: str, entity: str = "entity", year: str = "year") -> DataFrame:
    """Resolves the wildcard arm W (T from the first T on, C before) and adds treated, first_treated, event_time, cohort, category."""
    w = Window.partitionBy(entity)
    first_raw = F.min(F.when(F.col(arm) == "T", F.col(year))).over(w)
    x = cells.withColumn("_first", first_raw).withColumn("arm_raw", F.col(arm))
    x = x.withColumn(arm, F.when(F.col(arm) != "W", F.col(arm)).when(F.col("_first").isNotNull() & (F.col(year) >= F.col("_first")), "T").otherwise("C"))
    n, n_t = F.count("*").over(w), F.sum((F.col(arm) == "T").cast("int")).over(w)
    first = F.min(F.when(F.col(arm) == "T", F.col(year))).over(w)
    c_later = F.max(F.when(F.col(arm) == "C", F.col(year))).over(w)
    category = F.when(n_t == n, "always_treated").when(n_t == 0, "never_treated").when(c_later < first, "clean_adoption").otherwise("reversion")
    return x.select(*[c for c in cells.columns], "arm_raw", (F.col(arm) == "T").cast("long").alias("treated"), first.alias("first_treated"), (F.col(year) - first).alias("event_time"), category.alias("category"))


def never_treated(entities: DataFrame, created: str, years: tuple[int, int], entity: str = "entity", year: str = "year") -> DataFrame:
    """A row for each year from the entity's creation to the end of the window."""
    start = F.greatest(F.coalesce(F.col(created), F.lit(years[0])), F.lit(years[0])).cast("long")
    return entities.withColumn("_s", start).filter(F.col("_s") <= years[1]).select(*entities.columns, F.explode(F.sequence("_s", F.lit(years[1]).cast("long"))).alias(year))
