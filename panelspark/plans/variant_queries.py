"""Queries on documents of the first form, whole detection runs, patches, comparisons and entities found by several patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions import text
from panelspark.operators import documents, review, segment, validation, variants
from panelspark.plans import document_queries
from panelspark.plans.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _first_form(spark: SparkSession, sf: str) -> DataFrame:
    """Each order as a document of the first form, in seven ways by its key, with numbers as such documents write them."""
    row = F.struct(*[F.col(c) for c in ("l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")])
    x = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(row)).alias("l"))
    k, even, size = F.col("l_orderkey") % 7, F.col("l_orderkey") % 2 == 0, F.size("l")
    label = lambda r: F.concat(F.lit("I-"), r["l_linenumber"].cast("string"))
    rate = lambda r: F.when(r["l_quantity"] < 3, "n/d").otherwise(r["l_discount"].cast("string"))
    peso = lambda c: F.concat(F.lit("$"), F.format_number(c, 2))
    lower = lambda r, i: peso(i * 1000 + F.when(i > 0, 0.01).otherwise(0.0) + F.when((i > 0) & (r["l_quantity"] > 48), 500).otherwise(0))
    upper = lambda i: F.when(i == size - 1, "En Adelante").otherwise(peso((i + 1) * 1000))

    def bracket(r, i):
        fixed = F.when(k == 0, (i * 100).cast("double")).otherwise(r["l_extendedprice"])
        return F.struct(label(r).alias("n"), lower(r, i).alias("lower"), upper(i).alias("upper"), peso(fixed).alias("fixed"), F.when(k == 0, r["l_discount"].cast("string")).otherwise("0").alias("rate"))

    def single(r):
        unit = F.when(r["l_returnflag"] == "R", "porcentaje").when(r["l_returnflag"] == "A", "otra")
        return F.struct(label(r).alias("label"), rate(r).alias("rate"), unit.alias("unit"))

    def mixed(r, i):
        columns = F.create_map(F.lit("tasa"), r["l_tax"].cast("string"), F.lit("cuota"), peso(r["l_extendedprice"]))
        return F.struct(label(r).alias("n"), lower(r, i).alias("lower"), upper(i).alias("upper"), columns.alias("columns"))

    names = F.array(*[F.lit(v) for v in ("progresivo", "progresivo", "tarifa_millar", "tasa_unica", "cuota_fija", "mixto", "progresivo")])
    return x.select(
        "l_orderkey",
        F.get(names, k.cast("int")).alias("declared"),
        F.when(~even, "Tasa y cuota por rango").alias("comment"),
        F.when((k == 2) | (k == 0) & even, F.transform("l", lambda r: F.struct(label(r).alias("label"), rate(r).alias("rate")))).alias("millar"),
        F.when(k <= 1, F.transform("l", bracket)).alias("progresiva"),
        F.when(k == 3, F.transform("l", single)).alias("unica"),
        F.when(k == 4, F.transform("l", lambda r: F.struct(label(r).alias("label"), peso(r["l_extendedprice"]).alias("amount")))).alias("fija"),
        F.when(k == 5, F.transform("l", mixed)).alias("mixta"),
    )


@query("""
WITH l AS (SELECT l_orderkey, l_orderkey % 7 AS k, l_orderkey % 2 = 0 AS even, l_quantity AS q, l_extendedprice AS price, l_discount AS disc, l_tax AS tax, l_returnflag AS flag,
    row_number() OVER w - 1 AS i, lag(l_extendedprice) OVER w AS prev FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag)),
d AS (SELECT l_orderkey, any_value(k) AS k, any_value(even) AS even, count(*) AS n, bool_or(q < 3) AS missing, bool_or(i > 0 AND q > 48) AS gap, bool_or(disc > 0) AS any_rate, coalesce(bool_or(price < prev), false) AS falls,
    bool_or(flag = 'A') AS odd_unit, sum(round(price * 100)) AS prices, sum(round(disc * 1000)) AS discs, sum(round(tax * 100)) AS taxes FROM l GROUP BY 1),
f AS (SELECT *, CASE WHEN NOT (k = 2 OR k = 0 AND even) THEN 'few_rows' WHEN missing THEN 'no_value' END AS f1,
    CASE WHEN k > 1 OR n < 2 THEN 'few_rows' WHEN NOT (k = 0 AND any_rate) THEN 'no_rate' WHEN gap THEN 'brackets' END AS f2,
    CASE WHEN k <> 3 OR n <> 1 THEN 'not_one_row' WHEN missing THEN 'no_value' WHEN odd_unit THEN 'unit' END AS f3,
    CASE WHEN k <> 4 OR n <> 1 THEN 'not_one_row' END AS f4,
    CASE WHEN k > 1 OR n < 2 THEN 'few_rows' WHEN k = 1 AND falls THEN 'descending' WHEN gap THEN 'brackets' END AS f5,
    CASE WHEN k <> 5 OR n < 2 THEN 'few_rows' WHEN even THEN 'no_comment' WHEN gap THEN 'brackets' END AS f6 FROM d),
s AS (SELECT *, CASE WHEN k IN (0, 1, 6) AND f2 IS NULL THEN 'progresivo' WHEN f1 IS NULL THEN 'tarifa_millar' WHEN f2 IS NULL THEN 'progresivo' WHEN f3 IS NULL THEN 'tasa_unica' WHEN f4 IS NULL THEN 'cuota_fija_simple'
    WHEN f5 IS NULL THEN 'cuota_fija_escalonada' WHEN f6 IS NULL THEN 'mixto' ELSE 'otro_no_clasificado' END AS scheme FROM f)
SELECT l_orderkey, scheme, CASE WHEN scheme <> 'otro_no_clasificado' THEN n END::INT AS n_rows,
  CASE WHEN scheme IN ('progresivo', 'cuota_fija_escalonada', 'mixto') THEN 500 * n * (n - 1) END::BIGINT AS lower_sum,
  CASE WHEN scheme IN ('progresivo', 'cuota_fija_escalonada') THEN CASE k WHEN 0 THEN 5000 * n * (n - 1) ELSE prices END WHEN scheme = 'cuota_fija_simple' THEN prices END::BIGINT AS fixed_sum,
  CASE WHEN scheme IN ('progresivo', 'tarifa_millar', 'tasa_unica') THEN discs END::BIGINT AS rate_sum,
  CASE WHEN scheme = 'mixto' THEN prices + taxes END::BIGINT AS column_sum,
  CASE WHEN scheme = 'otro_no_clasificado' THEN 'tarifa_millar: ' || f1 || '; progresivo: ' || f2 || '; tasa_unica: ' || f3 || '; cuota_fija_simple: ' || f4 || '; cuota_fija_escalonada: ' || f5 || '; mixto: ' || f6 END AS faults,
  CASE WHEN scheme = 'otro_no_clasificado' THEN CASE WHEN k = 6 THEN 'segmento_vacio' ELSE 'estructura_no_estandar' END END AS category,
  CASE WHEN scheme = 'otro_no_clasificado' THEN CASE WHEN k = 6 THEN 0 WHEN k = 0 AND even THEN 2 * n ELSE n END END::INT AS n_raw FROM s
""")
def second_form_documents(spark: SparkSession, sf: str) -> DataFrame:
    """NST01, NST02, NST03, NST07: six mappers from the first form to the second, each variant's rules, the escape hatch with its rows."""
    d = variants.second_form(_first_form(spark, sf))
    total = lambda values, scale: F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + F.round(v * scale).cast("long"))
    of = lambda field: F.transform("rows", lambda r: r[field])
    cells = F.flatten(F.transform("rows", lambda r: F.transform(r["columns"], lambda c: c["value"])))
    return d.select("l_orderkey", "scheme", F.size("rows").alias("n_rows"), total(of("lower"), 1).alias("lower_sum"), total(of("fixed"), 100).alias("fixed_sum"), total(of("rate"), 1000).alias("rate_sum"), total(cells, 100).alias("column_sum"), "faults", "category", F.size("raw").alias("n_raw"))


@query(f"""
WITH hits AS ({document_queries.SQL["scheme_detectors"]}),
d AS (SELECT o_custkey AS entity, year(o_orderdate)::BIGINT AS year, l_orderkey AS a, detector, severity, signal, CASE severity WHEN 'SEV1-H' THEN 1 WHEN 'SEV1' THEN 2 WHEN 'SEV2' THEN 3 WHEN 'SEV3' THEN 4 ELSE 5 END AS r FROM hits JOIN orders ON o_orderkey = l_orderkey),
firsts AS (SELECT entity, year, detector, min((r, a, detector)) AS f FROM d GROUP BY 1, 2, 3), names AS (SELECT entity, year, string_agg(detector, ',' ORDER BY f) AS detectors FROM firsts GROUP BY 1, 2),
q AS (SELECT entity, year, substr(sha1(entity || '|' || year), 1, 12) AS id, arg_min(severity, r) AS severity, any_value(detectors) AS detectors, string_agg(detector || ': ' || signal, ' | ' ORDER BY r, a, detector, signal) AS signals FROM d JOIN names USING (entity, year) GROUP BY 1, 2),
log AS (SELECT substr(sha1(user_id || '|' || (1995 + event_id % 7)), 1, 12) AS id, event_type AS decision, json_extract_string(props, '$.k') AS notes FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_id % 7 ORDER BY ts DESC, event_id DESC) = 1)
SELECT q.*, coalesce(log.decision, '') AS decision, coalesce(log.notes, '') AS notes FROM q LEFT JOIN log USING (id)
""")
def detection_run(spark: SparkSession, sf: str) -> DataFrame:
    """DET21, HIL01, HIL02, SRT03: detectors over all documents, one queue row for each entity and year, the last decisions laid over it, in order."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("entity"), F.year("o_orderdate").cast("long").alias("year"))
    hits = document_queries.scheme_detectors(spark, sf).join(o, "l_orderkey")
    log = table(spark, sf, "events").select(text.short_id(F.col("user_id").cast("string"), (F.col("event_id") % 7 + 1995).cast("string")).alias("id"), F.col("event_type").alias("decision"), F.get_json_object("props", "$.k").alias("notes"), "ts", "event_id")
    return review.run(hits, log, ["entity", "year"], "l_orderkey", "ts", "event_id")


_WRITTEN = "CASE o_orderkey % 5 WHEN 0 THEN '  ' || upper(p) || '.' WHEN 1 THEN replace(p, 'g', '') WHEN 2 THEN p || ', low' WHEN 3 THEN '' ELSE replace(p, 'iu', 'ui') END"


@query(f"""
WITH w AS (SELECT o_orderkey, lower(substr(o_orderpriority, 3)) AS p, o_orderkey % 5 AS k FROM orders), x AS (SELECT o_orderkey, rtrim(trim(lower({_WRITTEN})), '.') AS s FROM w), y AS (SELECT o_orderkey, trim(split_part(s, ',', 1)) AS s FROM x)
SELECT o_orderkey, CASE s WHEN 'urent' THEN 'urgent' WHEN 'hih' THEN 'high' WHEN 'meduim' THEN 'medium' ELSE s END AS term FROM y
""")
def canonical_terms(spark: SparkSession, sf: str) -> DataFrame:
    """STR14: the first of a list of words, with common misspellings mapped to the right form."""
    o = table(spark, sf, "orders").select("o_orderkey", F.lower(F.substring("o_orderpriority", 3, 100)).alias("p"))
    return o.select("o_orderkey", text.canonical_term(F.expr(_WRITTEN), {"urent": "urgent", "hih": "high", "meduim": "medium"}).alias("term"))


@query("""
WITH n AS (SELECT user_id, event_id, event_type, props, value, lag(event_id) OVER w AS prev, lag(event_type) OVER w AS p_type, lag(props) OVER w AS p_props, lag(value) OVER w AS p_value FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT event_id, unnest(['a.kind', 'a.rows.0.k', CASE WHEN value > 100 THEN 'a.rows.1.amount' END]) AS path, unnest([event_type, json_extract_string(props, '$.k'), CASE WHEN value > 100 THEN value::VARCHAR END]) AS v FROM n WHERE prev IS NOT NULL),
a AS (SELECT event_id, unnest(['a.kind', 'a.rows.0.k', CASE WHEN p_value > 100 THEN 'a.rows.1.amount' END]) AS path, unnest([p_type, json_extract_string(p_props, '$.k'), CASE WHEN p_value > 100 THEN p_value::VARCHAR END]) AS v FROM n WHERE prev IS NOT NULL)
SELECT event_id, path, a.v AS before, b.v AS after, CASE WHEN a.v IS NULL THEN 'added' WHEN b.v IS NULL THEN 'removed' ELSE 'changed' END AS what
FROM (SELECT * FROM a WHERE path IS NOT NULL) a FULL JOIN (SELECT * FROM b WHERE path IS NOT NULL) b USING (event_id, path) WHERE a.v IS DISTINCT FROM b.v
""")
def json_deep_diff(spark: SparkSession, sf: str) -> DataFrame:
    """NST09: added, removed and changed values at any depth between an entity's consecutive documents."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    json = F.concat(F.lit('{"a":{"kind":"'), "event_type", F.lit('","rows":['), "props", F.when(F.col("value") > 100, F.concat(F.lit(',{"amount":"'), F.col("value").cast("string"), F.lit('"}'))).otherwise(""), F.lit("]}}"))
    e = table(spark, sf, "events").select("event_id", json.alias("after"), F.lag(json).over(w).alias("before")).filter("before IS NOT NULL")
    return documents.deep_differences(e, ["event_id"], "before", "after")


@query("""
WITH o AS (SELECT o_custkey AS entity, year(o_orderdate)::BIGINT AS year, o_orderstatus AS scheme, count(*) AS n FROM orders GROUP BY 1, 2, 3),
a AS (SELECT entity, year, arg_min(scheme, scheme) AS scheme, sum(n)::BIGINT AS n FROM o WHERE scheme <> 'P' GROUP BY 1, 2), b AS (SELECT entity, year, arg_max(scheme, scheme) AS scheme, sum(n)::BIGINT AS n FROM o WHERE scheme <> 'F' GROUP BY 1, 2)
SELECT entity, year, coalesce(a.scheme, '—') AS before_scheme, coalesce(b.scheme, '—') AS after_scheme, a.n AS before_n, b.n AS after_n, b.n - a.n AS delta_n,
  CASE WHEN a.n IS NULL THEN 'new' WHEN b.n IS NULL THEN 'lost' WHEN a.scheme <> b.scheme THEN 'scheme' WHEN a.n <> b.n THEN 'rows' ELSE 'same' END AS outcome FROM a FULL JOIN b USING (entity, year)
""")
def before_and_after(spark: SparkSession, sf: str) -> DataFrame:
    """OTH42: two runs over the same cells side by side, with the change in rows and an outcome."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("entity"), F.year("o_orderdate").cast("long").alias("year"), F.col("o_orderstatus").alias("scheme"))
    by = ["entity", "year"]
    before = o.filter("scheme <> 'P'").groupBy(*by).agg(F.min("scheme").alias("scheme"), F.count("*").alias("n"))
    after = o.filter("scheme <> 'F'").groupBy(*by).agg(F.max("scheme").alias("scheme"), F.count("*").alias("n"))
    return review.runs_compared(before, after, by)


@query("""
WITH idx AS (SELECT l_orderkey, l_linenumber, l_suppkey AS file, year(l_shipdate)::BIGINT AS year, l_partkey AS part, l_quantity FROM lineitem),
patch AS (SELECT part, min(file) AS file FROM idx WHERE year = 1998 GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_quantity, year, part, CASE WHEN year = 1997 THEN coalesce(patch.file, idx.file) ELSE idx.file END AS file, CASE WHEN year = 1997 AND patch.file IS NOT NULL THEN 'patched' ELSE 'indexed' END AS status FROM idx LEFT JOIN patch USING (part)
""")
def patched_year(spark: SparkSession, sf: str) -> DataFrame:
    """OTH22: a second scan overrides the indexed rows of one year and no other."""
    idx = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.year("l_shipdate").cast("long").alias("year"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("file"))
    patch = idx.filter("year = 1998").groupBy("part").agg(F.min("file").alias("file"))
    return review.patched(idx.withColumn("status", F.lit("indexed")), patch, "part", F.col("year") == 1997, ["file"], "status", "patched")


#: How names stand in a text, each with the name as group 1, and words that rule out what follows them.
ENTITIES = [("plain", r"\b(?:of|de|the)\s+([a-zà-ÿ]+)"), ("led", r"^([A-Z][a-z]+)\s+(?:is|le)\b"), ("listed", r",\s+([a-zà-ÿ]+)\s+and\b")]
RULED_OUT = ["by the", "with"]


@query()
def entities_by_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """TXT10: names by several patterns, without those behind excluded words, each once with its first pattern and place."""
    return segment.entities(table(spark, sf, "documents"), "doc_id", "text", ENTITIES, RULED_OUT, 40)


@query(f"""
WITH s AS ({SQL["second_form_documents"]}),
x AS (
  SELECT o_custkey AS entity, year(o_orderdate)::BIGINT AS year, l_orderkey, 'doc_' || l_orderkey || '.json' AS path, scheme, scheme <> 'otro_no_clasificado' AS valid, coalesce(n_rows, 0) AS n, category,
    ['progresivo', 'progresivo', 'tarifa_millar', 'tasa_unica', 'cuota_fija', 'mixto', 'progresivo'][l_orderkey % 7 + 1] AS declared FROM s JOIN orders ON o_orderkey = l_orderkey
), p AS (
  SELECT *, CASE WHEN scheme IN ('progresivo', 'tarifa_millar') THEN n ELSE 0 END AS m, lag(scheme) OVER w AS ps, lag(valid) OVER w AS pv, lag(year) OVER w AS py, lag(CASE WHEN scheme IN ('progresivo', 'tarifa_millar') THEN n ELSE 0 END) OVER w AS pm,
    row_number() OVER w AS rn FROM x WINDOW w AS (PARTITION BY entity ORDER BY year, l_orderkey)
), a AS (
  SELECT *, list_sort(list_filter([CASE WHEN NOT valid THEN 'otro_no_clasificado_' || category WHEN declared <> scheme THEN 'reclasificado_de_' || declared || '_a_' || scheme END,
    CASE WHEN valid AND pv AND scheme <> ps THEN 'cambio_esquema_' || ps || '_a_' || scheme || '_desde_' || py END, CASE WHEN pm > 0 AND m > 0 AND (m > 2 * pm OR 2 * m < pm) THEN 'cambio_brusco_n_filas_' || pm || '_a_' || m END], lambda t: t IS NOT NULL)) AS anomalies FROM p
), years AS (SELECT DISTINCT entity, year FROM x), span AS (SELECT unnest(range(min(year), max(year) + 1)) AS year FROM x),
grid AS (SELECT e.entity, span.year, years.year IS NOT NULL AS there FROM (SELECT DISTINCT entity FROM x) e CROSS JOIN span LEFT JOIN years ON years.entity = e.entity AND years.year = span.year)
SELECT 'summary' AS output, entity, year, scheme AS value, array_to_string(anomalies, '|') AS detail, valid, path, NULL::INT AS n_years, NULL::INT AS n_missing, CASE WHEN scheme = 'tarifa_millar' THEN n ELSE 0 END::INT AS n_tarifa_rows,
  CASE WHEN scheme = 'progresivo' THEN n ELSE 0 END::INT AS n_prog_rows, CASE WHEN scheme = 'tasa_unica' THEN n ELSE 0 END::INT AS n_tasa_unica_rows, CASE WHEN scheme IN ('cuota_fija_simple', 'cuota_fija_escalonada') THEN n ELSE 0 END::INT AS n_cuota_fija_rows, CASE WHEN scheme = 'mixto' THEN n ELSE 0 END::INT AS n_mixta_rows FROM a
UNION ALL SELECT 'anomalies', entity, year, unnest(anomalies), NULL, NULL, path, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM a
UNION ALL SELECT 'schema_timeline', entity, year, scheme, NULL, valid, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM a
UNION ALL SELECT 'schema_switches', entity, year, ps, scheme, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM a WHERE valid AND pv AND ps <> scheme
UNION ALL SELECT 'coverage_by_muni', entity, NULL, coalesce(string_agg(year, ';' ORDER BY year) FILTER (WHERE there), ''), coalesce(string_agg(year, ';' ORDER BY year) FILTER (WHERE NOT there), ''), NULL, NULL, count(*) FILTER (WHERE there), count(*) FILTER (WHERE NOT there), NULL, NULL, NULL, NULL, NULL FROM grid GROUP BY entity
UNION ALL SELECT 'stability_flags', entity, year, CASE scheme WHEN 'progresivo' THEN 'prog' ELSE 'millar' END || '_rowcount_jump_' || pm || '_to_' || m, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM a WHERE ps = scheme AND m > 0 AND pm > 0 AND abs(m - pm) > 2
""")
def validation_run(spark: SparkSession, sf: str) -> DataFrame:
    """NST05, NST04: every document brought to its variant and counted, rules between years, and all outputs of the run as one tagged table."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("year"))
    docs = _first_form(spark, sf).join(o, "l_orderkey").withColumn("path", F.concat(F.lit("doc_"), F.col("l_orderkey").cast("string"), F.lit(".json")))
    return validation.outputs(docs, "entity", "year", "l_orderkey", "path")
