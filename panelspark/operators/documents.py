"""Nested tariff documents: flattening, validation, reclassification, anomaly detectors, year-to-year differences.

A document is a wide struct with a tag (``scheme``) that says which of its fields count. Detectors are a registry of
name, severity and Column rule over one row for each document; they are evaluated in one pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions import nested, text
from panelspark.sources import files


@dataclass(frozen=True)
class Detector:
    name: str
    severity: str
    fires: Callable[[], Column]
    signal: Callable[[], Column]


def flatten(docs: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """A row for each element of an array of structs, with its position; documents without elements keep one row of nulls."""
    return docs.select(*keys, F.posexplode_outer(rows).alias("position", "_r")).select(*keys, "position", "_r.*")


def variant_checks(rows: str = "rows") -> list[tuple[str, Column]]:
    """Variants in order of trial and what a document needs to be one. rows: array of struct lower, upper, fixed, rate, columns."""
    t = F.col(rows)
    some = F.coalesce(F.size(t) > 0, F.lit(False))
    every = lambda p: some & F.coalesce(F.forall(t, p), F.lit(False))
    ascending = F.size(nested.bracket_breaks(t)) == 0
    return [
        ("progresivo", every(lambda r: r["lower"].isNotNull() & r["fixed"].isNotNull() & r["rate"].isNotNull()) & ascending & F.exists(t, lambda r: r["rate"] != 0)),
        ("cuota_fija_escalonada", every(lambda r: r["lower"].isNotNull() & r["fixed"].isNotNull()) & ascending),
        ("tarifa_millar", every(lambda r: r["rate"].isNotNull() & r["lower"].isNull())),
        ("cuota_fija_simple", every(lambda r: r["fixed"].isNotNull() & r["lower"].isNull() & r["rate"].isNull())),
    ]


def reclassify(docs: DataFrame, declared: str, rows: str = "rows") -> DataFrame:
    """Adds scheme (the declared variant if it holds, else the first that does, else the escape hatch), valid and problems."""
    checks = variant_checks(rows)
    t = F.col(rows)
    problems = nested.reasons((F.coalesce(F.size(t) < 1, F.lit(True)), "tabla_vacia"), (F.size(nested.bracket_breaks(t)) > 0, "rangos_discontinuos"), (F.coalesce(F.forall(t, lambda r: r["rate"] == 0) & (F.size(t) > 0), F.lit(False)), "tasas_cero"))
    return docs.withColumn("scheme", nested.reclassified(F.col(declared), checks)).withColumn("valid", F.col("scheme") == F.col(declared)).withColumn("problems", problems)


def table_detectors(rows: str = "rows", scheme: str = "scheme", description: str | None = None) -> list[Detector]:
    """The rules that look at one document's table."""
    t, s = F.col(rows), F.col(scheme)
    prog = s == "progresivo"
    top = lambda: F.array_max(F.filter(F.transform(t, lambda r: r["rate"]), lambda x: x.isNotNull() & (x != 0)))
    found = [
        Detector("tabla_vacia", "SEV1", lambda: (s != "otro_no_clasificado") & (F.coalesce(F.size(t), F.lit(0)) < 1), lambda: s),
        Detector("otro_no_clasificado", "SEV1", lambda: s == "otro_no_clasificado", lambda: F.lit("")),
        Detector("progresivo_tasa_cero", "SEV1", lambda: prog & (F.size(t) > 0) & F.forall(t, lambda r: F.coalesce(r["rate"], F.lit(1.0)) == 0), lambda: F.size(t).cast("string")),
        Detector("bracket_superior_cerrado", "SEV2", lambda: prog & F.try_element_at(t, F.lit(-1))["upper"].isNotNull(), lambda: F.try_element_at(t, F.lit(-1))["upper"].cast("string")),
        Detector("rangos_no_monotonos", "SEV2", lambda: nested.first_drop(F.transform(t, lambda r: r["fixed"])).isNotNull(), lambda: nested.first_drop(F.transform(t, lambda r: r["fixed"])).cast("string")),
        Detector("tarifa_millar_factor", "SEV2", lambda: (s == "tarifa_millar") & (top() < 0.5), lambda: top().cast("string")),
    ]
    if description:
        found.append(Detector("desc_transitorios", "SEV1", lambda: F.col(description).rlike("(?i)transitori"), lambda: F.regexp_extract(description, "(?i)(transitori\\w*)", 1)))
    return found


def declared_detectors(rows: str = "rows", scheme: str = "scheme") -> list[Detector]:
    """The rules on a table as it is declared. Only brackets of a progressive table must not fall; bands of fixed amounts may."""
    t, s = F.col(rows), F.col(scheme)
    fall = nested.first_drop(F.transform(t, lambda r: r["fixed"]))
    top = F.array_max(F.filter(F.transform(t, lambda r: r["rate"]), lambda x: x.isNotNull() & (x != 0)))
    kept = {"tabla_vacia", "otro_no_clasificado", "progresivo_tasa_cero"}
    return [
        *[d for d in table_detectors(rows, scheme) if d.name in kept],
        Detector("rangos_no_monotonos", "SEV2", lambda: (s == "progresivo") & fall.isNotNull(), lambda: fall.cast("string")),
        Detector("tarifa_millar_factor", "SEV2", lambda: (s == "tarifa_millar") & (top < 0.5), lambda: F.format_string("%.2f", top)),
    ]


#: Words of passing provisions, which show that a description comes from the wrong section; fixed values.
PASSING = r"(?i)\b(transitor|abrog|salario\s*m[ií]nim|d[ií]as?\s+de\s+salario|vsm\b|vigencia|publicaci[oó]n\s+oficial)"


def scheme_detectors(rows: str = "rows", scheme: str = "scheme", category: str = "category", minimum: str = "minimum") -> list[Detector]:
    """The rules that look at one scheme. rows: array of struct upper, rate, fixed, unit, description, columns (array of name, kind)."""
    t, s, first = F.col(rows), F.col(scheme), F.get(rows, F.lit(0))
    any_row = F.coalesce(F.size(t), F.lit(0)) > 0
    cells = F.flatten(F.transform(t, lambda r: r["columns"]))
    names, kinds = F.array_distinct(F.transform(cells, lambda c: c["name"])), F.array_distinct(F.transform(cells, lambda c: c["kind"]))
    single = any_row & F.forall(t, lambda r: F.coalesce(F.size(r["columns"]), F.lit(0)) == 1) & (F.size(names) == 1) & (F.size(kinds) == 1) & (F.get(kinds, F.lit(0)) == "cuota_fija")
    top = F.array_max(F.filter(F.transform(t, lambda r: r["rate"]), lambda x: x.isNotNull() & (x != 0)))
    low = F.when(first["unit"] == "porcentaje", first["rate"] < 0.05).when(first["unit"] == "al_millar", first["rate"] < 0.5)
    passing = F.get(F.filter(F.transform(t, lambda r: F.regexp_extract(F.coalesce(r["description"], F.lit("")), PASSING, 1)), lambda x: x != ""), F.lit(0))
    fixed = s.isin("cuota_fija", "cuota_fija_simple") & any_row
    is_minimum = F.concat_ws(";", F.when(text.norm_light(F.coalesce(first["description"], F.lit(""))).contains("minim"), "desc=minim*"), F.when(F.abs(first["fixed"] - F.col(minimum)) < 0.01, "monto==minimo_predial"))
    other = s == "otro_no_clasificado"
    external = F.coalesce(F.col(category), F.lit("?")) == "remite_a_ley_externa"
    last_upper = F.try_element_at(t, F.lit(-1))["upper"]
    return [
        Detector("mixto_monocolumna_cuotafija", "SEV1", lambda: (s == "mixto") & single, lambda: F.get(names, F.lit(0))),
        Detector("remite_a_ley_externa", "SEV3", lambda: other & external, lambda: F.lit("")),
        Detector("otro_no_clasificado", "SEV1", lambda: other & ~external, lambda: F.coalesce(F.col(category), F.lit("?"))),
        Detector("bracket_superior_cerrado", "SEV2", lambda: (s == "progresivo") & last_upper.isNotNull(), lambda: last_upper.cast("long").cast("string")),
        Detector("tarifa_millar_factor", "SEV2", lambda: (s == "tarifa_millar") & (top < 0.5), lambda: F.format_number(top, 2)),
        Detector("tasa_unica_unidad_factor", "SEV2", lambda: (s == "tasa_unica") & low, lambda: first["unit"]),
        Detector("desc_transitorios", "SEV1", lambda: passing.isNotNull(), lambda: F.lower(passing)),
        Detector("cuota_es_minimo", "QA", lambda: fixed & (is_minimum != ""), lambda: is_minimum),
        Detector("legacy_cuota_fija", "QA", lambda: s == "cuota_fija", lambda: F.lit("literal")),
        Detector("legacy_desconocido", "QA", lambda: s == "desconocido", lambda: F.lit("desconocido")),
    ]


def detect(docs: DataFrame, keys: list[str], detectors: list[Detector]) -> DataFrame:
    """A row for each detector that fires on a document: keys, detector, severity, signal. One pass over the documents."""
    hits = [F.when(F.coalesce(d.fires(), F.lit(False)), F.struct(F.lit(d.name).alias("detector"), F.lit(d.severity).alias("severity"), F.coalesce(d.signal(), F.lit("")).alias("signal"))) for d in detectors]
    return docs.select(*keys, F.inline(F.array_compact(F.array(*hits))))


def year_differences(docs: DataFrame, entity: str, year: str, rows: str, key: str, value: str, scheme: str) -> DataFrame:
    """Differences of each document to the entity's previous observed one: scheme change, or keyed rows added, removed, changed.

    ``label`` is the least serious code among the differences (3 for changed values, 2 for rows added or removed, 1 for the
    scheme); ``worst`` is the most serious.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(entity).orderBy(year)
    x = docs.withColumns({"_rows": F.lag(rows).over(w), "_scheme": F.lag(scheme).over(w), "prev_year": F.lag(year).over(w)}).filter("prev_year IS NOT NULL")
    diff = nested.keyed_diff(F.col("_rows"), F.col(rows), lambda r: r[key], lambda r: r[value])
    x = x.withColumn("_d", diff).withColumn("scheme_changed", ~F.col(scheme).eqNullSafe(F.col("_scheme")))
    n = lambda what: F.size(F.filter("_d", lambda d: d["what"] == what)).cast("long")
    x = x.withColumns({"added": n("added"), "removed": n("removed"), "changed": n("changed")})
    codes = F.array_compact(F.array(F.when(F.col("scheme_changed"), 1), F.when(F.col("added") + F.col("removed") > 0, 2), F.when(F.col("changed") > 0, 3)))
    return x.select(entity, year, "prev_year", "scheme_changed", "added", "removed", "changed", F.array_max(codes).alias("label"), F.array_min(codes).alias("worst"))


def diff_by_scheme(before: Column, after: Column, scheme: Column, differs: dict[str, tuple[str, str]]) -> Column:
    """Keyed differences by the rule of the document's scheme: a registry of scheme to (key field, value field); null for others."""
    text_of = lambda f: lambda r: r[f].cast("string")
    field_of = lambda f: lambda r: r[f]
    out = None
    for name, (key, value) in differs.items():
        diff = nested.keyed_diff(before, after, text_of(key), field_of(value))
        out = F.when(scheme == name, diff) if out is None else out.when(scheme == name, diff)
    return out


def corpus_comparison_flags(a: Column, b: Column, other: str = "otro_no_clasificado") -> Column:
    """regression: classified before, the escape hatch now; gain: the reverse; changed; same."""
    return F.when(a.isNull() | b.isNull(), "unpaired").when((a != other) & (b == other), "regression").when((a == other) & (b != other), "gain").when(a != b, "changed").otherwise("same")


def deep_values(document: DataFrame, keys: list[str], json: str) -> DataFrame:
    """Every value of a JSON text at any depth, whatever its keys: keys, path, value as text.

    One level is unfolded at a time; objects and arrays inside it are stored for the next, until a level has none.
    """
    spark = document.sparkSession
    names = [f"d.`{k}`" for k in keys]
    is_nested = "schema_of_variant(v) LIKE 'OBJECT%' OR schema_of_variant(v) LIKE 'ARRAY%'"
    level, out = document.select(*keys, F.lit(None).cast("string").alias("path"), F.try_parse_json(json).alias("v")), None
    while out is None or not level.isEmpty():
        path = "concat_ws('.', d.path, coalesce(e.key, cast(e.pos AS string))) AS path"
        one = spark.sql(f"SELECT {', '.join([*names, path, 'e.value AS v'])} FROM {{level}} d, LATERAL variant_explode(d.v) e", level=level)
        flat = one.filter(f"NOT ({is_nested})").select(*keys, "path", F.col("v").cast("string").alias("value"))
        out = flat if out is None else out.unionByName(flat)
        stored = files.scratch_path(spark, "level")
        one.filter(is_nested).write.parquet(stored)
        level = spark.read.schema(one.schema).parquet(stored)
    return out


def deep_differences(pairs: DataFrame, keys: list[str], before: str, after: str) -> DataFrame:
    """Values added, removed or changed at any depth between two JSON texts of a row: keys, path, before, after, what.

    Both texts are unfolded together and meet in one aggregate by key and path; a JSON null is no value.
    """
    sides = F.explode(F.array(F.struct(F.lit(0).alias("_side"), F.col(before).alias("_json")), F.struct(F.lit(1).alias("_side"), F.col(after).alias("_json")))).alias("_x")
    values = deep_values(pairs.select(*keys, sides).select(*keys, "_x._side", "_x._json"), [*keys, "_side"], "_json")
    both = values.groupBy(*keys, "path").agg(F.max(F.when(F.col("_side") == 0, F.col("value"))).alias("before"), F.max(F.when(F.col("_side") == 1, F.col("value"))).alias("after"))
    what = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed")
    return both.filter(~F.col("before").eqNullSafe(F.col("after"))).withColumn("what", what)


def rescue_needed(variants: Column, scheme: str, description: str, phrases: str) -> Column:
    """Whether any variant is the escape hatch and its description lacks the phrases that explain it."""
    return F.exists(variants, lambda v: (v[scheme] == "otro_no_clasificado") & ~F.lower(F.coalesce(v[description], F.lit(""))).rlike(phrases))


def adapted(rows: Column, fixed_factor: float = 1.0, rate_factor: float = 1.0) -> Column:
    """Rows of a hard-coded table in the library's units, with upper bounds from the next lower ones."""
    scaled = F.transform(rows, lambda r: r.withField("fixed", r["fixed"] * fixed_factor).withField("rate", r["rate"] * rate_factor))
    return nested.upper_from_next(scaled)


def imputed_document(document: Column, method: Column, strict: tuple[str, ...], emptied: list[str]) -> Column:
    """A donor's document: whole for strict methods, without the fields named for the others."""
    skeleton = document
    for f in emptied:
        skeleton = skeleton.withField(f, F.when(F.lit(False), document[f]))
    return F.when(method.isin(*strict), document).otherwise(skeleton)


def struct_diff(a: Column, b: Column, fields: list[str]) -> Column:
    """The names of the fields that differ, null equal to null."""
    return F.array_compact(F.array(*[F.when(~a[f].eqNullSafe(b[f]), F.lit(f)) for f in fields]))


def mixed_columns(as_map: Column, as_list: Column) -> Column:
    """Columns given as a map or as a list of (name, value), as a list in order of name."""
    from_map = F.transform(F.map_entries(as_map), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value")))
    return F.array_sort(F.coalesce(as_list, from_map))
