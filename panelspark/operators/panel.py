"""Entity-by-period panels: keep-first assembly, the year spine, neighbours, imputation and coverage.

A panel is a DataFrame with one row for each entity and year. Observations of an entity number at most one for each year
of the window, so after the keep-first aggregation an entity's rows fit in one small array: the spine is one shuffle by
entity, and windows over the entity reuse it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Years that a strict rule may bridge; fixed value.
MAX_GAP = 4


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an explicit order; a map-side minimum, not a window."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row")).select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in an explicit order."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row")).select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def union_by_priority(*sources: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """All rows of the sources, the earlier source winning a key."""
    ranked = [s.withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    all_rows = ranked[0]
    for s in ranked[1:]:
        all_rows = all_rows.unionByName(s, allowMissingColumns=True)
    return keep_first(all_rows, keys, [F.col("_source"), *[F.col(c) for c in order]]).drop("_source")


def spine(obs: DataFrame, years: tuple[int, int], entity: str = "entity", year: str = "year", since: str | None = None) -> DataFrame:
    """Every entity in every year of the window, with the observed values or nulls, and ``observed``.

    obs: one row for each entity and year. since: a column of the entity's first year; earlier cells don't exist.
    """
    values = [c for c in obs.columns if c not in (entity, year, since)]
    row = F.struct(F.col(year).cast("long").alias(year), *values)
    first = F.coalesce(F.max(F.col(since)), F.lit(years[0])) if since else F.lit(years[0])
    by_entity = obs.groupBy(entity).agg(F.collect_list(F.when(F.col(year).between(*years), row)).alias("_rows"), F.greatest(first, F.lit(years[0])).cast("long").alias("_since"))
    cells = by_entity.filter(F.col("_since") <= years[1]).withColumn("_y", F.explode(F.sequence("_since", F.lit(years[1]).cast("long"))))
    hit = F.get(F.filter("_rows", lambda r: r[year] == F.col("_y")), F.lit(0))
    return cells.withColumn("_hit", hit).select(entity, F.col("_y").alias(year), *[F.col(f"_hit.`{v}`").alias(v) for v in values], F.col("_hit").isNotNull().alias("observed"), *([F.col("_since").alias(since)] if since else []))


def with_neighbours(cells: DataFrame, values: list[str], entity: str = "entity", year: str = "year") -> DataFrame:
    """Adds prev and next (nearest observed cells on either side) and first and last (of the entity): structs of year and values."""
    row = F.when(F.col("observed"), F.struct(F.col(year).alias("y"), *values))
    w = Window.partitionBy(entity).orderBy(year)
    return cells.withColumns(
        {
            "prev": F.last(row, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
            "next": F.first(row, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)),
            "first": F.first(row, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
            "last": F.last(row, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    )


def same_schema(a: Column, b: Column, kind: str, others: list[str]) -> Column:
    """Equal and filled kinds, and the other values equal as texts with blank equal to null."""
    text = lambda x, c: F.coalesce(x[c].cast("string"), F.lit(""))
    out = (text(a, kind) != "") & (text(a, kind) == text(b, kind))
    for c in others:
        out = out & (text(a, c) == text(b, c))
    return F.coalesce(out, F.lit(False))


def impute(cells: DataFrame, kind: str, others: list[str], entity: str = "entity", year: str = "year", max_gap: int = MAX_GAP, donors: DataFrame | None = None, group: str | None = None) -> DataFrame:
    """Fills unobserved cells by rule and says how: imputed_method, imputed_from_year, gap_reason.

    Rules look at observed cells only: between equal neighbours (confirmed_fill), from the past (ffill), from the future
    (bfill), between equal ends of the series (closure_fill), by kind alone (tipo_only_fill, other values become null), and
    from a donor of the same group and year (uniform_state_fill). donors: group, year, and the donor's entity and values.
    """
    values = [kind, *others]
    x = with_neighbours(cells, values, entity, year)
    p, n = F.col("prev"), F.col("next")
    y = F.col(year)
    gap = n["y"] - p["y"] - 1
    both, close = p.isNotNull() & n.isNotNull(), gap <= max_gap
    rules = [
        ("confirmed_fill", both & close & same_schema(p, n, kind, others), p),
        ("ffill", p.isNotNull() & (y - p["y"] <= max_gap) & (n.isNull() | (gap > max_gap)), p),
        ("bfill", n.isNotNull() & p.isNull() & (n["y"] - y <= max_gap), n),
        ("closure_fill", (F.col("first.y") < y) & (y < F.col("last.y")) & same_schema(F.col("first"), F.col("last"), kind, others), F.col("first")),
        ("tipo_only_fill", both & close & same_schema(p, n, kind, []), p),
    ]
    if donors is not None and group is not None:
        d = donors.select(F.col(group).alias("_g"), F.col(year).alias("_y"), F.struct(F.col(year).alias("y"), *values, F.col(entity).alias("e")).alias("_donor"))
        x = x.join(d, (F.col(group) == F.col("_g")) & (y == F.col("_y")), "left").drop("_g", "_y")
        rules.append(("uniform_state_fill", F.col("_donor").isNotNull() & (F.col("_donor.e") != F.col(entity)), F.col("_donor")))
    method = F.when(F.col("observed"), F.lit(""))
    for name, holds, _ in rules:
        method = method.when(F.coalesce(holds, F.lit(False)), F.lit(name))
    x = x.withColumn("imputed_method", method)
    m = F.col("imputed_method")

    def pick(field: str) -> Column:
        out = F.when(m == "", y if field == "y" else F.col(field))
        for name, _, src in rules:
            out = out.when(m == name, F.lit(None) if name == "tipo_only_fill" and field in others else src[field])
        return out

    nearest = F.least(y - p["y"], n["y"] - y)
    reason = F.when(m.isNotNull(), F.lit(None)).when(p.isNull() & n.isNull(), "no_data").when(both & close, "schema_discontinuity").when(nearest > max_gap, "long_gap").otherwise("edge")
    keep = [c for c in cells.columns if c not in values]
    return x.select(*keep, *[pick(v).alias(v) for v in values], "imputed_method", F.when(m != "", pick("y")).alias("imputed_from_year"), reason.alias("gap_reason"))


def nearest_fill(cells: DataFrame, values: list[str], entity: str = "entity", year: str = "year") -> DataFrame:
    """Unobserved cells take the nearest observed one; the past wins a tie."""
    x = with_neighbours(cells, values, entity, year)
    p, n, y = F.col("prev"), F.col("next"), F.col(year)
    use_p = p.isNotNull() & (n.isNull() | (y - p["y"] <= n["y"] - y))
    return x.select(*[c for c in cells.columns if c not in values], *[F.when(F.col("observed"), F.col(v)).when(use_p, p[v]).otherwise(n[v]).alias(v) for v in values], F.when(F.col("observed"), y).when(use_p, p["y"]).otherwise(n["y"]).alias("from_year"))


def forced_grid(cells: DataFrame, values: list[str], entity: str = "entity", year: str = "year") -> DataFrame:
    """Unobserved cells take the last observed one, else the next, however far."""
    x = with_neighbours(cells, values, entity, year)
    how = F.when(F.col("observed"), "raw").when(F.col("prev").isNotNull(), "ffill").when(F.col("next").isNotNull(), "bfill").otherwise("none")
    return x.select(*[c for c in cells.columns if c not in values], *[F.when(F.col("observed"), F.col(v)).otherwise(F.coalesce(F.col("prev")[v], F.col("next")[v])).alias(v) for v in values], how.alias("method"))


def mode_of(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The most frequent value of each key; ties go to the least value."""
    n = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return n.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(name))


def modal_cascade(cells: DataFrame, kind: str, group: str, default: str, entity: str = "entity", year: str = "year") -> DataFrame:
    """Unobserved cells take the entity's mode, else the mode of its group in the year, else a default."""
    seen = cells.filter("observed")
    mine, peers = mode_of(seen, [entity], kind, "_mine"), mode_of(seen, [group, year], kind, "_peers")
    x = cells.join(mine, entity, "left").join(peers, [group, year], "left")
    how = F.when(F.col("observed"), "raw").when(F.col("_mine").isNotNull(), "modal_entity").when(F.col("_peers").isNotNull(), "modal_group").otherwise("default")
    return x.withColumn("method", how).withColumn(kind, F.when(F.col("observed"), F.col(kind)).otherwise(F.coalesce("_mine", "_peers", F.lit(default)))).drop("_mine", "_peers")


def canonical_priority(obs: DataFrame, kind: str, priority: list[str], years: tuple[int, int], entity: str = "entity", year: str = "year") -> DataFrame:
    """The latest year of each entity's best-ranked kind, spread over all years."""
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col(kind))
    best = obs.filter(rank > 0).groupBy(entity).agg(F.min_by(F.struct(F.col(kind).alias("k"), F.col(year).alias("y")), F.struct(rank.alias("r"), -F.col(year))).alias("_b"))
    return best.select(entity, F.explode(F.sequence(F.lit(years[0]).cast("long"), F.lit(years[1]).cast("long"))).alias(year), F.col("_b.k").alias(kind), F.col("_b.y").alias("source_year"))


def category_fill(cells: DataFrame, arm: str, entity: str = "entity", year: str = "year") -> DataFrame:
    """Entities by what their observed arms say: always, never, cohort (absorbing from the first T), reversion (nearest), no_data."""
    w = Window.partitionBy(entity)
    is_t = F.col("observed") & (F.col(arm) == "T")
    first_t = F.min(F.when(is_t, F.col(year))).over(w)
    c_after = F.max(F.when(F.col("observed") & (F.col(arm) != "T"), F.col(year))).over(w)
    c_before = F.min(F.when(F.col("observed") & (F.col(arm) != "T"), F.col(year))).over(w)
    category = F.when(first_t.isNull() & c_after.isNull(), "no_data").when(first_t.isNull(), "never").when(c_after.isNull(), "always").when(c_after < first_t, "cohort").when(c_before.isNotNull(), "reversion").otherwise("always")
    x = with_neighbours(cells.withColumn("category", category).withColumn("_first_t", first_t), [arm], entity, year)
    p, n, y = F.col("prev"), F.col("next"), F.col(year)
    near = F.when(p.isNotNull() & (n.isNull() | (y - p["y"] <= n["y"] - y)), p[arm]).otherwise(n[arm])
    filled = F.when(F.col("observed"), F.col(arm)).when(F.col("category") == "always", "T").when(F.col("category") == "never", "C").when(F.col("category") == "cohort", F.when(y >= F.col("_first_t"), "T").otherwise("C")).when(F.col("category") == "reversion", near)
    return x.select(*[c for c in cells.columns if c != arm], "category", filled.alias(arm))


def coverage(cells: DataFrame, by: list[str], filled: Column | None = None) -> DataFrame:
    """Cells, observed, filled and their shares in percent, for each group."""
    done = filled if filled is not None else F.col("observed")
    return cells.groupBy(*by).agg(
        F.count("*").alias("ideal"),
        F.sum(F.col("observed").cast("long")).alias("raw"),
        F.sum(done.cast("long")).alias("balanced"),
    ).withColumn("raw_pct", F.round(100 * F.col("raw") / F.col("ideal"), 4)).withColumn("balanced_pct", F.round(100 * F.col("balanced") / F.col("ideal"), 4))
