"""Rules on arrays of brackets and on tagged documents, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def max_and_count(table: Column, field: str) -> tuple[Column, Column]:
    """Rows of a table and the largest value of a field (null if none has one)."""
    return F.coalesce(F.size(table), F.lit(0)), F.array_max(F.transform(table, lambda r: r[field]))


def bracket_breaks(table: Column, tolerance: float = 1.0) -> Column:
    """Positions i where bracket i + 1 doesn't begin where bracket i ends, its bound isn't above, or i is open before the last."""
    pairs = F.zip_with(F.slice(table, 1, F.greatest(F.size(table) - 1, F.lit(0))), F.slice(table, 2, F.greatest(F.size(table), F.lit(1))), lambda a, b: a["upper"].isNull() | (F.abs(b["lower"] - a["upper"]) > tolerance) | (b["lower"] <= a["lower"]))
    return F.filter(F.transform(pairs, lambda bad, i: F.when(F.coalesce(bad, F.lit(True)), i)), lambda i: i.isNotNull())


def snapped(table: Column, tolerance: float = 1.0) -> Column:
    """Lower bounds moved to the upper bound before them where the gap is within the tolerance."""

    def one(r: Column, i: Column) -> Column:
        before = F.get(table, i - 1)["upper"]
        return r.withField("lower", F.when((i > 0) & (F.abs(r["lower"] - before) <= tolerance), before).otherwise(r["lower"]))

    return F.transform(table, one)


def first_drop(values: Column, slack: float = 0.01) -> Column:
    """The first position whose value is below the one before it by more than the slack; null if none is."""
    bad = F.filter(F.sequence(F.lit(1), F.greatest(F.size(values) - 1, F.lit(1))), lambda i: F.coalesce(F.get(values, i) < F.get(values, i - 1) - slack, F.lit(False)))
    return F.get(bad, F.lit(0))


def upper_from_next(table: Column) -> Column:
    """Upper bounds taken from the next lower bound; the last stays open."""
    return F.transform(table, lambda r, i: r.withField("upper", F.get(table, i + 1)["lower"]))


def keyed_diff(before: Column, after: Column, key: Callable[[Column], Column], value: Callable[[Column], Column], tolerance: float = 0.01) -> Column:
    """Keys added, removed or changed between two arrays: array of (key, what, old, new), in order of key; null keys last."""
    k0, k1 = F.transform(before, key), F.transform(after, key)
    keys = F.array_sort(F.array_distinct(F.concat(k0, k1)))

    def at(rows: Column, k: Column) -> Column:
        return F.get(F.filter(rows, lambda r: key(r).eqNullSafe(k)), F.lit(0))

    def one(k: Column) -> Column:
        old, new = value(at(before, k)), value(at(after, k))
        has0, has1 = F.exists(k0, lambda x: x.eqNullSafe(k)), F.exists(k1, lambda x: x.eqNullSafe(k))
        what = F.when(~has0, "added").when(~has1, "removed").when(~F.coalesce(F.abs(old - new) <= tolerance, old.isNull() & new.isNull()), "changed")
        return F.struct(k.alias("key"), what.alias("what"), old.alias("old"), new.alias("new"))

    return F.filter(F.transform(keys, one), lambda d: d["what"].isNotNull())


def reclassified(declared: Column, variants: list[tuple[str, Column]], other: str = "otro_no_clasificado") -> Column:
    """The declared variant if the document fits it, else the first variant in order that it fits, else ``other``."""
    own = F.coalesce(*[F.when((declared == n) & ok, F.lit(n)) for n, ok in variants])
    first = F.coalesce(*[F.when(ok, F.lit(n)) for n, ok in variants])
    return F.coalesce(own, first, F.lit(other))


def reasons(*checks: tuple[Column, str]) -> Column:
    """The texts of the checks that hold, joined by "; "."""
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(t)) for c, t in checks])), "; ")


def trajectory(years: tuple[int, int], marks: Column, missing: str = "·") -> Column:
    """One character for each year from a map of year to mark."""
    return F.array_join(F.transform(F.sequence(F.lit(years[0]), F.lit(years[1])), lambda y: F.coalesce(F.try_element_at(marks, y), F.lit(missing))), "")


def run_compacted(c: Column) -> Column:
    """Runs of one character as that character."""
    return F.regexp_replace(c, "(.)\\1+", "$1")


def trajectory_pattern(seq: Column) -> Column:
    """A name for a string of T and C."""
    compact = run_compacted(seq)
    return (
        F.when(F.coalesce(seq, F.lit("")) == "", "vacio")
        .when(compact == "T", "siempre_T")
        .when(compact == "C", "siempre_C")
        .when(compact == "CT", "clean_onset")
        .when(compact == "TC", "reversion_simple")
        .when(compact == "TCT", "outlier_year_C_in_T")
        .when(compact == "CTC", "outlier_year_T_in_C")
        .when(compact.isin("CTCT", "TCTC"), F.concat(F.lit("flip_x2["), compact, F.lit("]")))
        .otherwise(F.concat(F.lit("multi_flip["), compact, F.lit("]")))
    )
