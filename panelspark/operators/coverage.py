"""Cells of a panel without a document, what may stand for them, and the queue rows that follow from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.numeric import rounded_as_sql
from panelspark.functions.text import short_id

#: Reasons of documents, the longest text of a hint and the longest reason in a signal; fixed values of the queue.
NO_LAW, HINT_CHARS, REASON_CHARS = "sin_ley", 160, 120
ASK = {
    "hint": "Confirmar PDF+span (re_segmentar) o marcar sin_ley.",
    "none": "Sin extracción ni focus localizado. Localizar PDF+span (re_segmentar) o marcar sin_ley si no hubo ley de ingresos.",
    "failed": "Re-extraer (reextraer) o re_segmentar.",
    "forced": "fin del segmento adivinado (no se encontró siguiente impuesto)",
    "expanded": "segmento expandido por ser muy corto",
}


def empty_cells(entities: DataFrame, years: tuple[int, int], documents: DataFrame, hints: DataFrame | None = None) -> DataFrame:
    """Cells (entity, year) that no document fills, with the best hint for each: entity, year, hint (raw, score, source), null without one.

    hints: entity, year, raw, score, source; of several for a cell the one of the highest score, then the least text. A hint belongs to one cell.
    """
    spine = entities.select("entity").distinct().withColumn("year", F.explode(F.sequence(F.lit(years[0]).cast("long"), F.lit(years[1]).cast("long"))))
    empty = spine.join(documents.select("entity", F.col("year").cast("long").alias("year")), ["entity", "year"], "left_anti")
    if hints is None:
        return empty.withColumn("hint", F.lit(None).cast("struct<raw:string,score:double,source:string>"))
    told = F.struct(F.substring(F.regexp_replace(F.btrim("raw"), r"\s+", " "), 1, HINT_CHARS).alias("raw"), rounded_as_sql(F.col("score")).alias("score"), "source")
    best = hints.groupBy("entity", F.col("year").cast("long").alias("year")).agg(F.min_by(told, F.struct(-F.col("score"), "raw")).alias("hint"))
    return empty.join(best, ["entity", "year"], "left")


def coverage_queue(empty: DataFrame, documents: DataFrame) -> DataFrame:
    """Queue rows (entity, year, detector, severity, signal): cells without a document, with their hints, and documents without a table.

    documents: entity, year, has_table, reason. Documents whose reason says that there is no law give no row.
    """
    hint = F.concat(F.lit("Sin extracción. Pista de focus huérfano: «"), "hint.raw", F.lit("» (score "), F.col("hint.score").cast("string"), F.lit("; "), F.coalesce("hint.source", F.lit("")), F.lit("). " + ASK["hint"]))
    row = lambda detector, severity, signal: F.struct(F.lit(detector).alias("detector"), F.lit(severity).alias("severity"), signal.alias("signal"))
    cells = empty.select("entity", "year", row("cobertura_incompleta", "SEV2", F.when(F.col("hint").isNotNull(), hint).otherwise(ASK["none"])).alias("_r"))
    failed = documents.filter(~F.coalesce("has_table", F.lit(False)) & (F.coalesce("reason", F.lit("?")) != NO_LAW))
    said = F.concat(F.lit("Extracción falló (predial=null): "), F.substring(F.coalesce("reason", F.lit("?")), 1, REASON_CHARS), F.lit(". " + ASK["failed"]))
    return cells.unionByName(failed.select("entity", F.col("year").cast("long").alias("year"), row("extraccion_fallida", "SEV1", said).alias("_r"))).select("entity", "year", "_r.*")


def unverified_boundaries(spans: DataFrame, key: str, forced: str, expanded: str) -> DataFrame:
    """Sections whose end was guessed or that were expanded: key, detector, severity, signal."""
    signal = F.concat_ws("; ", F.when(F.col(forced), ASK["forced"]), F.when(F.col(expanded), ASK["expanded"]))
    return spans.filter(F.coalesce(forced, F.lit(False)) | F.coalesce(expanded, F.lit(False))).select(key, F.lit("frontera_sin_verificar").alias("detector"), F.lit("SEV1-H").alias("severity"), signal.alias("signal"))


def verification_rows(decided: DataFrame, documents: DataFrame, queue: DataFrame, bounds: tuple[int, int], step: Column, direction: Column) -> DataFrame:
    """What decisions on a cell ask of the year next to it: entity, year, id, signal, reused.

    decided: entity, year, decision; ``step`` (-1 or 1) is the year looked at from there. Only years strictly inside ``bounds`` that have a
    document; a row that the queue (entity, year, id) has already is reused. Decisions that ask for the same cell give one row, of the least year.
    """
    year = (F.col("year") + step).cast("long")
    signal = F.concat(F.lit("Verificación temporal ("), direction, F.lit("): tras '"), "decision", F.lit("' en "), F.col("year").cast("string"), F.lit(", revisar consistencia "), (year - 1).cast("string"), F.lit("→"), year.cast("string"))
    asked = decided.select("entity", year.alias("year"), F.struct(F.col("year").alias("from"), "decision", signal.alias("signal")).alias("_a")).filter((F.col("year") > bounds[0]) & (F.col("year") < bounds[1]))
    once = asked.groupBy("entity", "year").agg(F.min("_a").alias("_a"))
    there = once.join(documents.select("entity", F.col("year").cast("long").alias("year")).distinct(), ["entity", "year"], "left_semi")
    known = queue.groupBy("entity", F.col("year").cast("long").alias("year")).agg(F.min("id").alias("_id"))
    fresh = short_id(F.col("entity").cast("string"), F.col("year").cast("string"), F.lit("verificacion_temporal"))
    return there.join(known, ["entity", "year"], "left").select("entity", "year", F.coalesce("_id", fresh).alias("id"), F.col("_a.signal").alias("signal"), F.col("_id").isNotNull().alias("reused"))


def short_gap_changes(observations: DataFrame, fields: dict[str, str], kind: str, most: int = 4) -> DataFrame:
    """Gaps of 1 to ``most`` years between observations that differ: entity, year_a, year_b, gap, same_kind, diff.

    fields: column to its name in ``diff``; null counts as an empty text. Observations without a kind don't count as a side.
    """
    w = Window.partitionBy("entity").orderBy("year")
    before = F.lag(F.struct("year", *fields)).over(w)
    x = observations.withColumn("_a", before).withColumn("gap", F.col("year") - F.col("_a.year") - 1)
    said = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    differs = {f: said(F.col(f)) != said(F.col(f"_a.{f}")) for f in fields}
    diff = F.concat_ws(" | ", *[F.when(d, F.concat(F.lit(f"{fields[f]}:"), said(F.col(f"_a.{f}")), F.lit("→"), said(F.col(f)))) for f, d in differs.items()])
    x = x.filter((F.col("gap") > 0) & (F.col("gap") <= most) & (said(F.col(kind)) != "") & (said(F.col(f"_a.{kind}")) != ""))
    return x.select("entity", F.col("_a.year").alias("year_a"), F.col("year").alias("year_b"), "gap", (~differs[kind]).alias("same_kind"), diff.alias("diff")).filter(F.col("diff") != "")
