"""The validation run over documents of the first form: one row for each document, and the outputs that are made from these.

Documents are read once, brought to the second form and counted; what comes of it is stored, since it is small beside them. All
outputs are then one table with a tag, made in one pass over the stored rows: windows by entity share a shuffle, and a row
gives as many tagged rows as it has something to say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.operators import variants
from panelspark.sources.files import stored

#: Counts of a document's rows, and the variants that each counts; fixed values.
COUNTS = {"n_tarifa_rows": ("tarifa_millar",), "n_prog_rows": ("progresivo",), "n_tasa_unica_rows": ("tasa_unica",), "n_cuota_fija_rows": ("cuota_fija_simple", "cuota_fija_escalonada"), "n_mixta_rows": ("mixto",)}
#: Outputs and their columns, by the names they have in files; fixed values.
OUTPUTS = {
    "summary": {"entity": "municipio_slug", "year": "anio", "value": "tipo_esquema", "valid": "esquema_valido", **{c: c for c in COUNTS}, "detail": "anomalias", "path": "json_path"},
    "anomalies": {"entity": "municipio", "year": "anio", "value": "anomalia", "path": "json_path"},
    "schema_timeline": {"entity": "municipio", "year": "anio", "value": "tipo_esquema", "valid": "esquema_valido"},
    "schema_switches": {"entity": "municipio", "year": "anio", "value": "de", "detail": "a"},
    "coverage_by_muni": {"entity": "municipio", "n_years": "n_years", "value": "years_present", "n_missing": "n_missing", "detail": "years_missing"},
    "stability_flags": {"entity": "municipio", "year": "anio", "value": "flag"},
}
_KINDS = {"year": "bigint", "value": "string", "detail": "string", "valid": "boolean", "path": "string", "n_years": "int", "n_missing": "int", **dict.fromkeys(COUNTS, "int")}


def structure(docs: DataFrame) -> DataFrame:
    """The report on each document: scheme, valid, rows of each type, and what is odd about it (anomalies)."""
    x = variants.second_form(docs)
    size, scheme = F.coalesce(F.size("rows"), F.lit(0)), F.col("scheme")
    counts = {c: F.when(scheme.isin(*names), size).otherwise(0).cast("int") for c, names in COUNTS.items()}
    other = scheme == variants.OTHER
    moved = F.when((F.coalesce("declared", F.lit("")) != "") & (F.col("declared") != scheme), F.concat(F.lit("reclasificado_de_"), F.col("declared"), F.lit("_a_"), scheme))
    odd = F.when(other, F.concat(F.lit("otro_no_clasificado_"), F.col("category"))).otherwise(moved)
    return x.withColumns({"valid": ~other, **counts, "anomalies": F.array_compact(F.array(odd))})


def validated(docs: DataFrame, entity: str, year: str, document: str, path: str) -> DataFrame:
    """Reports of all documents with the rules between the years of an entity: entity, year, document, path, scheme, valid, counts, anomalies."""
    kept = structure(docs).select(F.col(entity).alias("entity"), F.col(year).cast("long").alias("year"), F.col(document).alias("document"), F.col(path).alias("path"), "scheme", "valid", *COUNTS, "anomalies")
    w = Window.partitionBy("entity").orderBy("year", "document")
    prev = F.lag(F.struct("year", "scheme", "valid", *COUNTS)).over(w)
    x = kept.withColumn("prev", prev)
    before, now = (sum((F.col(p + c) for c in ("n_prog_rows", "n_tarifa_rows")), F.lit(0)) for p in ("prev.", ""))
    changed = F.col("valid") & F.col("prev.valid") & (F.col("scheme") != F.col("prev.scheme"))
    jump = (before > 0) & (now > 0) & ((now > 2 * before) | (2 * now < before))
    more = F.array_compact(
        F.array(
            F.when(changed, F.concat(F.lit("cambio_esquema_"), F.col("prev.scheme"), F.lit("_a_"), F.col("scheme"), F.lit("_desde_"), F.col("prev.year").cast("string"))),
            F.when(jump, F.concat(F.lit("cambio_brusco_n_filas_"), before.cast("string"), F.lit("_a_"), now.cast("string"))),
        )
    )
    return x.withColumn("anomalies", F.when(F.size(more) > 0, F.array_sort(F.array_distinct(F.concat("anomalies", more)))).otherwise(F.col("anomalies")))


def outputs(docs: DataFrame, entity: str, year: str, document: str, path: str) -> DataFrame:
    """All outputs as one table: output, entity, and the columns of ``OUTPUTS`` by their general names."""
    rows = stored(validated(docs, entity, year, document, path), "validated")
    span = rows.agg(F.min("year").alias("a"), F.max("year").alias("b")).first()
    w = Window.partitionBy("entity")
    x = rows.withColumns({"first": F.row_number().over(w.orderBy("year", "document")) == 1, "years": F.array_sort(F.collect_set("year").over(w))})
    every = F.sequence(F.lit(span.a).cast("long"), F.lit(span.b).cast("long")) if span.a is not None else F.array().cast("array<long>")
    missing = F.array_except(every, F.col("years"))

    def row(output: str, **fields):
        return F.struct(F.lit(output).alias("output"), F.col("entity"), *[fields.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in _KINDS.items()])

    listed = lambda c, by: F.array_join(c.cast("array<string>"), by)
    same = lambda scheme: (F.col("scheme") == scheme) & (F.col("prev.scheme") == scheme)

    def flag(scheme: str, count: str, name: str):
        a, b = F.col(f"prev.{count}"), F.col(count)
        return F.when(same(scheme) & (a > 0) & (b > 0) & (F.abs(a - b) > 2), F.array(row("stability_flags", year=F.col("year"), value=F.concat(F.lit(name), a.cast("string"), F.lit("_to_"), b.cast("string")))))

    switched = (F.col("scheme") != F.col("prev.scheme")) & (F.col("scheme") != variants.OTHER) & (F.col("prev.scheme") != variants.OTHER)
    said = [
        F.array(row("summary", year=F.col("year"), value=F.col("scheme"), valid=F.col("valid"), detail=listed(F.col("anomalies"), "|"), path=F.col("path"), **{c: F.col(c) for c in COUNTS})),
        F.transform("anomalies", lambda a: row("anomalies", year=F.col("year"), value=a, path=F.col("path"))),
        F.array(row("schema_timeline", year=F.col("year"), value=F.col("scheme"), valid=F.col("valid"))),
        F.when(switched, F.array(row("schema_switches", year=F.col("year"), value=F.col("prev.scheme"), detail=F.col("scheme")))),
        F.when(F.col("first"), F.array(row("coverage_by_muni", value=listed(F.col("years"), ";"), detail=listed(missing, ";"), n_years=F.size("years"), n_missing=F.size(missing)))),
        flag("progresivo", "n_prog_rows", "prog_rowcount_jump_"),
        flag("tarifa_millar", "n_tarifa_rows", "millar_rowcount_jump_"),
    ]
    return x.select(F.explode(F.flatten(F.array_compact(F.array(*said)))).alias("r")).select("r.*")


def output(tagged: DataFrame, name: str) -> DataFrame:
    """One output with the names it has in files."""
    return tagged.filter(F.col("output") == name).select(*[F.col(c).alias(alias) for c, alias in OUTPUTS[name].items()])


def write_outputs(tagged: DataFrame, path: str) -> None:
    """Every output to a folder of its own, in one pass."""
    tagged.repartition("output", "entity").write.partitionBy("output").parquet(path)
