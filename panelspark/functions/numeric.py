"""Brackets, indices and other number rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bracket_of(value: Column, table: Column) -> Column:
    """The last bracket (array of struct lower, upper, fixed, rate, ascending) whose lower bound isn't above the value; else the first."""
    return F.coalesce(F.try_element_at(F.filter(table, lambda b: b["lower"] <= value), F.lit(-1)), F.get(table, F.lit(0)))


def progressive_tax(value: Column, table: Column, signed_excess: bool = False) -> Column:
    """Fixed fee and marginal rate on what exceeds the lower bound. Below the first bound the excess is 0, or signed."""
    b = bracket_of(value, table)
    excess = value - b["lower"]
    return b["fixed"] + (excess if signed_excess else F.greatest(excess, F.lit(0.0))) * b["rate"]


def with_surcharge(tax: Column, percent: Column, least: Column) -> Column:
    return F.greatest(tax * (1 + percent / 100), least)


def two_column_tax(value: Column, built: Column, table_built: Column, table_vacant: Column) -> Column:
    return F.when(built, progressive_tax(value, table_built)).otherwise(progressive_tax(value, table_vacant))


def brackets(rows: DataFrame) -> DataFrame:
    """A table of brackets as one row with an array, for broadcasting: brackets number a few dozen."""
    return rows.agg(F.array_sort(F.collect_list(F.struct("lower", "upper", "fixed", "rate"))).alias("table"))


def rounded(x: Column, digits: int = 2) -> Column:
    """Half-even on the exact binary value, through the shortest decimal with enough digits."""
    return F.bround(x.cast("decimal(38,18)"), digits).cast("double")


def rounded_as_sql(x: Column, digits: int = 2) -> Column:
    """SQL's round of a double: the value times a power of ten to the nearest whole number, halves away from zero; a value too large for that stays."""
    scaled = x * 10.0**digits
    whole = F.when(scaled < 0, -F.round(-scaled, 0)).otherwise(F.round(scaled, 0))  # a small negative value keeps its sign
    return F.when(F.abs(scaled) < float("inf"), whole / 10.0**digits).otherwise(x)


def index_fold(rates: Column) -> Column:
    """Growth of an ordered array of percent rates: the product of 1 + rate / 100, minus 1."""
    return F.aggregate(rates, F.lit(1.0), lambda a, r: a * (1 + r / 100)) - 1


def chained_update(start: Column, factors: Column, digits: int = 2) -> Column:
    """Start times each factor in turn, rounded at every step: a recurrence, not a product."""
    return F.aggregate(factors, start.cast("double"), lambda a, f: F.round(a * f, digits))


def percent_factor(rates: Column) -> Column:
    """1000 where the largest rate that isn't 0 is under 0.5, which means a rate per one instead of per thousand; else 1."""
    top = F.array_max(F.filter(rates, lambda r: r.isNotNull() & (r != 0)))
    return F.when(top < 0.5, 1000).otherwise(1)


def unit_rate(rate: Column, unit: Column, period: Column) -> Column:
    """A rate per thousand and year: percents times 10, two-monthly ones times 6."""
    r = F.when(F.lower(unit).rlike("porcent|percent|%"), rate * 10).otherwise(rate)
    return F.when(F.lower(period).rlike("bimest|two-month"), r * 6).otherwise(r)


def upper_median(values: Column) -> Column:
    """Of the positive values in order, the one at half their number (the upper of two)."""
    v = F.array_sort(F.filter(values, lambda x: x > 0))
    return F.get(v, F.floor(F.size(v) / 2).cast("int"))
