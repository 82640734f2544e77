"""Documents of the first form (a text table for each kind) to the second (one tag, one typed table), as Column expressions.

A document of the first form has ``declared``, ``comment`` and five arrays of structs of texts: ``millar`` (label, rate),
``progresiva`` (n, lower, upper, fixed, rate), ``unica`` (label, rate, unit), ``fija`` (label, amount) and ``mixta`` (n, lower,
upper, columns: map of name to text). A mapper for each of the six variants reads its table into rows of one type; a variant
holds if nothing is wrong with its rows. Nothing is dropped: a document that no variant fits keeps its rows as they came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions import nested, text

#: Names of the variants in order of trial, their tables, and the units of a single rate; fixed values.
VARIANTS = {"tarifa_millar": "millar", "progresivo": "progresiva", "tasa_unica": "unica", "cuota_fija_simple": "fija", "cuota_fija_escalonada": "progresiva", "mixto": "mixta"}
UNITS = ("al_millar", "al_ciento", "porcentaje", "por_metro_cuadrado", "por_hectarea", "pesos")
TABLES = ("millar", "progresiva", "unica", "fija", "mixta")
BRACKETED = ("progresivo", "cuota_fija_escalonada", "mixto")
OTHER = "otro_no_clasificado"

#: Fields of a row of the second form.
FIELDS = {"n": "bigint", "label": "string", "lower": "double", "upper": "double", "fixed": "double", "rate": "double", "unit": "string", "columns": "array<struct<name:string,value:double>>"}


def _row(**fields: Column) -> Column:
    """A row of the second form; fields that a variant doesn't have are null."""
    return F.struct(*[fields.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in FIELDS.items()])


def _bounds(r: Column) -> dict[str, Column]:
    return {"n": text.label_number(r["n"]), "lower": text.lenient_number(r["lower"]), "upper": text.lenient_number(r["upper"])}


def _or_zero(c: Column) -> Column:
    return F.coalesce(text.lenient_number(c), F.lit(0.0))


def mapped(variant: str) -> Column:
    """The rows of the second form that a variant reads from its table, bounds as written; a missing table has none."""
    table = F.coalesce(F.col(VARIANTS[variant]), F.array())
    if variant == "tarifa_millar":
        return F.transform(table, lambda r: _row(label=r["label"], rate=text.lenient_number(r["rate"])))
    if variant == "progresivo":
        return F.transform(table, lambda r: _row(**_bounds(r), fixed=_or_zero(r["fixed"]), rate=_or_zero(r["rate"])))
    if variant == "tasa_unica":
        return F.transform(table, lambda r: _row(label=r["label"], rate=text.lenient_number(r["rate"]), unit=F.coalesce(r["unit"], F.lit("al_millar"))))
    if variant == "cuota_fija_simple":
        return F.transform(table, lambda r: _row(label=r["label"], fixed=text.lenient_number(r["amount"])))
    if variant == "cuota_fija_escalonada":
        return F.transform(table, lambda r: _row(**_bounds(r), fixed=_or_zero(r["fixed"])))
    columns = lambda r: F.transform(F.array_sort(F.map_entries(r["columns"])), lambda e: F.struct(e["key"].alias("name"), _or_zero(e["value"]).alias("value")))
    return F.transform(table, lambda r: _row(**_bounds(r), columns=columns(r)))


def fault(variant: str, rows: Column, comment: Column) -> Column:
    """What is wrong first with a variant's rows, or null: few_rows, not_one_row, no_value, unit, no_rate, no_comment, descending, brackets."""
    lacks = lambda field: F.exists(rows, lambda r: r[field].isNull())
    few, gap = F.when(F.size(rows) < 2, "few_rows"), F.when(F.size(nested.bracket_breaks(rows)) > 0, "brackets")
    no_bound = F.when(F.exists(rows, lambda r: r["lower"].isNull() | (r["lower"] < 0)), "no_value")
    if variant == "tarifa_millar":
        return F.coalesce(F.when(F.size(rows) < 1, "few_rows"), F.when(lacks("rate"), "no_value"))
    if variant == "progresivo":
        return F.coalesce(few, no_bound, F.when(~F.exists(rows, lambda r: r["rate"] > 0), "no_rate"), gap)
    if variant == "tasa_unica":
        return F.coalesce(F.when(F.size(rows) != 1, "not_one_row"), F.when(lacks("rate"), "no_value"), F.when(F.exists(rows, lambda r: ~r["unit"].isin(*UNITS)), "unit"))
    if variant == "cuota_fija_simple":
        return F.coalesce(F.when(F.size(rows) != 1, "not_one_row"), F.when(lacks("fixed"), "no_value"))
    if variant == "cuota_fija_escalonada":
        return F.coalesce(few, no_bound, F.when(nested.first_drop(F.transform(rows, lambda r: r["fixed"]), 0.0).isNotNull(), "descending"), gap)
    return F.coalesce(few, no_bound, F.when(F.trim(F.coalesce(comment, F.lit(""))) == "", "no_comment"), gap)


def raw_rows() -> Column:
    """All rows of all tables as they came: array of (table, row as JSON)."""
    return F.concat(*[F.transform(F.coalesce(F.col(t), F.array()), lambda r, t=t: F.struct(F.lit(t).alias("table"), F.to_json(r).alias("row"))) for t in TABLES])


def second_form(docs: DataFrame) -> DataFrame:
    """Adds scheme, rows, faults (variant to its fault), category and raw to documents of the first form.

    The declared variant if it holds, else the first that does, else the escape hatch with its category and the rows as they
    came. Gaps of up to one between brackets are closed first. Each step is a column of its own, so that it is worked out once.
    """
    x = docs.withColumns({f"_{v}": mapped(v) for v in VARIANTS})
    x = x.withColumns({f"_{v}": nested.snapped(F.col(f"_{v}")) for v in BRACKETED})
    x = x.withColumns({f"_f_{v}": fault(v, F.col(f"_{v}"), F.col("comment")) for v in VARIANTS})
    scheme = nested.reclassified(F.col("declared"), [(v, F.col(f"_f_{v}").isNull()) for v in VARIANTS], OTHER)
    faults = F.array_join(F.array_compact(F.array(*[F.concat(F.lit(f"{v}: "), F.col(f"_f_{v}")) for v in VARIANTS])), "; ")
    rows = F.coalesce(*[F.when(F.col("scheme") == v, F.col(f"_{v}")) for v in VARIANTS])
    other = F.col("scheme") == OTHER
    x = x.withColumn("scheme", scheme).withColumns({"rows": rows, "faults": F.when(other, faults), "raw": F.when(other, raw_rows())})
    x = x.withColumn("category", F.when(F.size("raw") > 0, "estructura_no_estandar").when(other, "segmento_vacio"))
    return x.drop(*[f"_{v}" for v in VARIANTS], *[f"_f_{v}" for v in VARIANTS])
