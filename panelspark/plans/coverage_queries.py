"""Queries on cells without documents, boundaries to verify, and changes inside short gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions import text
from panelspark.operators import coverage, documents, identity, review
from panelspark.plans import document_queries, review_queries
from panelspark.plans.tables import OBS, YEARS, observations, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Observations as documents: those of status P have no table, and urgent ones no law."""
    o = table(spark, sf, "orders")
    first = F.min_by(F.struct((F.col("o_orderstatus") != "P").alias("has_table"), F.when(F.col("o_orderpriority") == "1-URGENT", "sin_ley").otherwise(F.col("o_orderpriority")).alias("reason")), F.struct("o_orderdate", "o_orderkey"))
    return o.groupBy(F.col("o_custkey").alias("entity"), F.year("o_orderdate").cast("long").alias("year")).agg(first.alias("d")).select("entity", "year", "d.*")


_DOCS = """docs AS (SELECT o_custkey AS entity, year(o_orderdate)::BIGINT AS year, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) <> 'P' AS has_table,
  arg_min(CASE WHEN o_orderpriority = '1-URGENT' THEN 'sin_ley' ELSE o_orderpriority END, (o_orderdate, o_orderkey)) AS reason FROM orders GROUP BY 1, 2)"""


@query(f"""
WITH {_DOCS}, cells AS (SELECT c_custkey AS entity, y::BIGINT AS year FROM customer, (SELECT unnest(range(1995, 2002)) AS y)),
hints AS (SELECT user_id AS entity, 1995 + event_id % 7 AS year, arg_min(struct_pack(raw := event_type || ' ' || event_id, score := round(value / 100, 2), source := day(ts)::VARCHAR), (-value, event_type || '  ' || event_id)) AS h FROM events WHERE value IS NOT NULL GROUP BY 1, 2),
empty AS (SELECT c.* FROM cells c ANTI JOIN docs USING (entity, year))
SELECT entity, year, 'cobertura_incompleta' AS detector, 'SEV2' AS severity, coalesce('Sin extracción. Pista de focus huérfano: «' || h.raw || '» (score ' || h.score || '; ' || h.source || '). {coverage.ASK["hint"]}', '{coverage.ASK["none"]}') AS signal FROM empty LEFT JOIN hints USING (entity, year)
UNION ALL SELECT entity, year, 'extraccion_fallida', 'SEV1', 'Extracción falló (predial=null): ' || reason || '. {coverage.ASK["failed"]}' FROM docs WHERE NOT has_table AND reason <> 'sin_ley'
""")
def coverage_placeholders(spark: SparkSession, sf: str) -> DataFrame:
    """DET04, HIL06: cells of the spine without a document, with the best hint for each, and documents without a table; none where there is no law."""
    docs = _documents(spark, sf)
    hints = table(spark, sf, "events").filter("value IS NOT NULL").select(F.col("user_id").alias("entity"), (F.col("event_id") % 7 + 1995).alias("year"), F.concat("event_type", F.lit("  "), F.col("event_id").cast("string")).alias("raw"), (F.col("value") / 100).alias("score"), F.dayofmonth("ts").cast("string").alias("source"))
    empty = coverage.empty_cells(table(spark, sf, "customer").select(F.col("c_custkey").alias("entity")), YEARS, docs, hints)
    return coverage.coverage_queue(empty, docs)


@query()
def coverage_hints(spark: SparkSession, sf: str) -> DataFrame:
    """HIL06, FZY05: names that no document could place, matched at a low threshold, as hints of the empty cells of their catalog."""
    names, catalog, aliases = document_queries._raw_names(spark, sf)
    found = identity.hints(names, catalog, "block", "name", "key", ["year"], aliases)
    hints = found.select(F.col("key").alias("entity"), "year", F.col("name").alias("raw"), "score", F.col("block").alias("source"))
    filled = catalog.select(F.col("key").alias("entity"), (F.col("key") % 4).alias("year"))
    return coverage.empty_cells(catalog.select(F.col("key").alias("entity")), (0, 2), filled, hints).select("entity", "year", "hint.raw", "hint.score", "hint.source")


@query(f"""
WITH s AS ({review_queries.SQL["page_sections"]})
SELECT doc_id, 'frontera_sin_verificar' AS detector, 'SEV1-H' AS severity, concat_ws('; ', CASE WHEN forced THEN '{coverage.ASK["forced"]}' END, CASE WHEN expanded THEN '{coverage.ASK["expanded"]}' END) AS signal FROM s WHERE forced OR expanded
""")
def unverified_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    """DET01: sections found by pages whose end was guessed or that were expanded."""
    return coverage.unverified_boundaries(review_queries.page_sections(spark, sf), "doc_id", "forced", "expanded")


@query(f"""
WITH {_DOCS}, d AS (SELECT user_id AS entity, 1995 + event_id % 7 AS y, CASE WHEN event_type = 'purchase' THEN 'propagar_previo' ELSE 'corregir_previo' END AS decision FROM events WHERE event_type IN ('purchase', 'error')
  QUALIFY row_number() OVER (PARTITION BY user_id, event_id % 7 ORDER BY ts DESC, event_id DESC) = 1),
a AS (SELECT entity, y + CASE decision WHEN 'propagar_previo' THEN 1 ELSE -1 END AS year, min((y, decision)) AS f FROM d GROUP BY 1, 2),
b AS (SELECT a.entity, a.year, f[1] AS y, f[2] AS decision FROM a JOIN docs USING (entity, year) WHERE a.year > 1995 AND a.year < 2001)
SELECT entity, year, CASE WHEN entity % 3 = 0 THEN 'known' || entity || '_' || year ELSE substr(sha1(entity || '|' || year || '|verificacion_temporal'), 1, 12) END AS id,
  'Verificación temporal (' || CASE decision WHEN 'propagar_previo' THEN 'adelante' ELSE 'atrás' END || '): tras ''' || decision || ''' en ' || y || ', revisar consistencia ' || (year - 1) || '→' || year AS signal, entity % 3 = 0 AS reused FROM b
""")
def adjacent_years_enqueued(spark: SparkSession, sf: str) -> DataFrame:
    """HIL07: after a decision that copies between years, the year next to it is queued for verification, inside the panel and once."""
    e = table(spark, sf, "events").filter(F.col("event_type").isin("purchase", "error")).withColumn("cell", F.struct("user_id", (F.col("event_id") % 7 + 1995).alias("year")))
    last = review.latest_decisions(e.select("cell", "ts", "event_id", "event_type"), "cell", "ts", "event_id")
    decided = last.select(F.col("cell.user_id").alias("entity"), F.col("cell.year").alias("year"), F.when(F.col("event_type") == "purchase", "propagar_previo").otherwise("corregir_previo").alias("decision"))
    forward = F.col("decision") == "propagar_previo"
    docs = _documents(spark, sf)
    queue = docs.filter("entity % 3 = 0").select("entity", "year", F.concat(F.lit("known"), F.col("entity").cast("string"), F.lit("_"), F.col("year").cast("string")).alias("id"))
    return coverage.verification_rows(decided, docs, queue, YEARS, F.when(forward, 1).otherwise(-1), F.when(forward, "adelante").otherwise("atrás"))


@query(f"""
WITH {OBS}, p AS (SELECT *, lag(year) OVER w AS ya, lag(tipo) OVER w AS ta, lag(rangos) OVER w AS ra, lag(round(monto)::BIGINT) OVER w AS ma, round(monto)::BIGINT AS mb FROM obs WINDOW w AS (PARTITION BY entity ORDER BY year))
SELECT entity, ya AS year_a, year AS year_b, year - ya - 1 AS gap, ta = tipo AS same_kind, concat_ws(' | ', CASE WHEN ta <> tipo THEN 'tipo:' || ta || '→' || tipo END, CASE WHEN ra <> rangos THEN 'rangos:' || ra || '→' || rangos END, CASE WHEN ma <> mb THEN 'monto_max:' || ma || '→' || mb END) AS diff
FROM p WHERE year - ya - 1 BETWEEN 1 AND 4 AND (ta <> tipo OR ra <> rangos OR ma <> mb)
""")
def short_gap_changes(spark: SparkSession, sf: str) -> DataFrame:
    """DET18: gaps of one to four years whose sides differ, with the fields that do."""
    obs = observations(spark, sf).withColumn("monto", F.round("monto").cast("long"))
    return coverage.short_gap_changes(obs, {"tipo": "tipo", "rangos": "rangos", "monto": "monto_max"}, "tipo")


@query("""
WITH o AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'progresivo' WHEN 1 THEN 'tarifa_millar' WHEN 2 THEN 'cuota_fija_escalonada' ELSE 'otro_no_clasificado' END AS scheme FROM orders),
l AS (SELECT l_orderkey, CASE WHEN l_orderkey % 8 = 0 THEN 0 ELSE l_discount END AS rate, l_extendedprice AS fixed, row_number() OVER w - 1 AS i, lag(l_extendedprice) OVER w AS prev FROM lineitem WHERE l_quantity > 20 WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_extendedprice, l_discount)),
d AS (SELECT o_orderkey, scheme, count(l_orderkey) AS n, coalesce(bool_and(rate = 0), false) AS zero, min(i) FILTER (WHERE fixed < prev - 0.01) AS fall, max(rate) FILTER (WHERE rate <> 0) AS top FROM o LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT o_orderkey, 'tabla_vacia' AS detector, 'SEV1' AS severity, scheme AS signal FROM d WHERE scheme <> 'otro_no_clasificado' AND n = 0
UNION ALL SELECT o_orderkey, 'otro_no_clasificado', 'SEV1', '' FROM d WHERE scheme = 'otro_no_clasificado'
UNION ALL SELECT o_orderkey, 'progresivo_tasa_cero', 'SEV1', n::VARCHAR FROM d WHERE scheme = 'progresivo' AND n > 0 AND zero
UNION ALL SELECT o_orderkey, 'rangos_no_monotonos', 'SEV2', fall::VARCHAR FROM d WHERE scheme = 'progresivo' AND fall IS NOT NULL
UNION ALL SELECT o_orderkey, 'tarifa_millar_factor', 'SEV2', printf('%.2f', top) FROM d WHERE scheme = 'tarifa_millar' AND top < 0.5
""")
def declared_detectors(spark: SparkSession, sf: str) -> DataFrame:
    """DET06, DET08, DET10, DET17: rules on tables as their documents declare them, empty ones too; bands of fixed amounts may fall."""
    k = F.col("o_orderkey") % 4
    o = table(spark, sf, "orders").select("o_orderkey", F.when(k == 0, "progresivo").when(k == 1, "tarifa_millar").when(k == 2, "cuota_fija_escalonada").otherwise("otro_no_clasificado").alias("scheme"))
    row = F.struct("l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    r = table(spark, sf, "lineitem").filter("l_quantity > 20").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(row)).alias("l"))
    rate = F.transform("l", lambda x: F.struct(F.lit(None).cast("double").alias("upper"), x["l_extendedprice"].alias("fixed"), F.when(F.col("o_orderkey") % 8 == 0, 0.0).otherwise(x["l_discount"]).alias("rate")))
    docs = o.join(r, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("rows", rate)
    return documents.detect(docs, ["o_orderkey"], documents.declared_detectors())
