"""Queries on reports, nested answers, documents of several tariffs, texts judged and names tidied."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import aggregates, documents, reports, tariffs
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


@query("""
WITH s AS (SELECT c_nationkey AS nation, c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1, 2), o AS (SELECT *, row_number() OVER (ORDER BY nation, segment) AS i, count(*) OVER () AS size FROM s)
SELECT 'markdown' AS style, i + 1 AS line, '| ' || nation || ' | ' || segment || ' | ' || n || ' |' AS text FROM o UNION ALL SELECT 'latex', i + 2, nation || ' & ' || segment || ' & ' || n || ' \\\\' FROM o
UNION ALL SELECT 'markdown', unnest([0, 1]), unnest(['| nation | segment | n |', '|---|---|---|']) UNION ALL SELECT 'latex', unnest([0, 1, 2]), unnest(['\\begin{tabular}{lll}', 'nation & segment & n \\\\', '\\hline']) UNION ALL SELECT DISTINCT 'latex', size + 3, '\\end{tabular}' FROM o
""")
def report_tables(spark: SparkSession, sf: str) -> DataFrame:
    """SRC27: a table of counts as the lines of a Markdown and of a LaTeX report."""
    n = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n"))
    lines = [reports.report_lines(n, ["nation", "segment"], style).withColumn("style", F.lit(style)) for style in ("markdown", "latex")]
    return lines[0].unionByName(lines[1])


@query("""
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'second' ELSE 'first' END AS source, 'nivel_' || o_orderstatus AS grp, o_orderkey // 2 AS id, year(o_orderdate)::INT AS year, 'cust_' || o_custkey AS slug FROM orders),
a AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY id ORDER BY source, o_orderkey) = 1), b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY year, slug ORDER BY source, o_orderkey) = 1)
SELECT source, grp AS "group", id, year, slug, o_orderkey AS number FROM b
""")
def nested_answers(spark: SparkSession, sf: str) -> DataFrame:
    """OTH21: records of nested groups in the answers of two sources, once by id and once by year and name."""
    o = table(spark, sf, "orders")
    record = F.struct((F.floor(F.col("o_orderkey") / 2)).alias("id"), F.year("o_orderdate").alias("year"), F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")).alias("slug"), F.col("o_orderkey").alias("number"))
    source = F.when(F.col("o_orderkey") % 5 == 0, "second").otherwise("first")
    # an answer for each source and day, its groups by status
    groups = o.groupBy(source.alias("source"), F.to_date("o_orderdate").alias("day"), F.concat(F.lit("nivel_"), "o_orderstatus").alias("g")).agg(F.collect_list(record).alias("items"))
    answers = groups.groupBy("source", "day").agg(F.map_from_entries(F.collect_list(F.struct("g", "items"))).alias("agrupadas")).select("source", F.to_json(F.struct("agrupadas", F.lit("ok").alias("estado"))).alias("answer"))
    found = reports.nested_records(answers, "source", "answer", "agrupadas", "id:bigint,year:int,slug:string,number:bigint")
    return reports.deduplicated_records(found, "id", ["year", "slug"], [F.col("source"), F.col("number")])


@query("""
WITH l AS (SELECT o_custkey, l_orderkey, l_returnflag, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem JOIN orders ON o_orderkey = l_orderkey QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_linenumber ORDER BY l_quantity, l_discount, l_tax) = 1),
n AS (SELECT o_custkey, count(DISTINCT l_orderkey) AS n_tariffs, count(DISTINCT (l_orderkey, l_returnflag)) AS n_blocks FROM l GROUP BY 1)
SELECT o_custkey, l_orderkey AS tariff, 'urbano ' || l_returnflag AS scope, l_returnflag AS category, l_linenumber AS position, l_quantity AS lower, 'cuota=' || l_discount || ';tasa=' || l_tax AS columns, n_tariffs::INT AS n_tariffs, n_blocks::INT AS n_blocks
FROM (SELECT *, min(l_returnflag) OVER (PARTITION BY l_orderkey) AS f FROM l) JOIN n USING (o_custkey)
""".replace("'urbano ' || l_returnflag", "'urbano'"))
def several_tariffs(spark: SparkSession, sf: str) -> DataFrame:
    """NST08, NST12: documents assembled from several tariffs of blocks of rows, columns as maps or lists, and flattened again."""
    li = table(spark, sf, "lineitem").join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    one = li.groupBy("o_custkey", "l_orderkey", "l_returnflag", "l_linenumber").agg(F.min(F.struct("l_quantity", "l_discount", "l_tax")).alias("v"))
    as_map = F.to_json(F.create_map(F.lit("tasa"), F.col("v.l_tax"), F.lit("cuota"), F.col("v.l_discount")))
    as_list = F.to_json(F.array(F.struct(F.lit("tasa").alias("name"), F.col("v.l_tax").alias("value")), F.struct(F.lit("cuota").alias("name"), F.col("v.l_discount").alias("value"))))
    rows = one.select("o_custkey", F.col("l_orderkey").alias("tariff"), F.lit("urbano").alias("scope"), F.col("l_returnflag").alias("category"), F.col("l_linenumber").alias("position"), F.col("v.l_quantity").alias("lower"), tariffs.columns_of(F.when(F.col("l_orderkey") % 2 == 0, as_map).otherwise(as_list)).alias("columns"))
    docs = tariffs.assembled(rows, "o_custkey", ["tariff", "scope"], ["category"], "position", ["lower", "columns"])
    sizes = docs.select(F.col("o_custkey").alias("k"), F.size("tariffs").alias("n_tariffs"), F.aggregate("tariffs", F.lit(0), lambda a, t: a + F.size(t["blocks"])).alias("n_blocks"))
    flat = tariffs.taken_apart(docs, "o_custkey").join(sizes, F.col("o_custkey") == F.col("k")).drop("k")
    return flat.withColumn("columns", F.array_join(F.transform("columns", lambda c: F.concat(c["name"], F.lit("="), c["value"].cast("string"))), ";"))


@query(r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, strip_accents(lower(coalesce(text, ''))) AS p FROM documents)
SELECT doc_id, CASE WHEN len(regexp_extract_all(p, '\bthe\b')) = 0 AND len(regexp_extract_all(p, '\bque\b')) = 0 THEN 'no_predial_in_pdf'
  WHEN len(regexp_extract_all(p, '\bthe\b')) >= 2 AND regexp_matches(p, 'ing') AND len(regexp_extract_all(t, '\$\s?[0-9]{1,3}(?:[,.]?[0-9]{3})*(?:\.[0-9]{2})?')) >= 5 THEN 'pattern_miss'
  WHEN len(regexp_extract_all(p, '\bthe\b')) >= 1 AND length(t) < 5000 THEN 'low_quality_ocr' ELSE 'ambiguo' END AS category FROM (SELECT doc_id, t || repeat(' $ 1,234.50', (doc_id % 8)::INT) AS t, p FROM d)
""")
def missed_sections(spark: SparkSession, sf: str) -> DataFrame:
    """TXT15: why a text has no section, by what words and amounts it holds."""
    t = F.concat(F.coalesce("text", F.lit("")), F.repeat(F.lit(" $ 1,234.50"), (F.col("doc_id") % 8).cast("int")))
    return table(spark, sf, "documents").select("doc_id", reports.missed_section(t, r"\bthe\b", r"\bque\b", "ing").alias("category"))


@query(r"""
WITH x AS (SELECT o_orderkey, o_orderkey % 4 AS k, CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 5 WHEN 2 THEN 4 ELSE 0 END AS n FROM orders)
SELECT o_orderkey, k IN (0, 1) AS title, k IN (1, 2) AS article, n >= 5 AS "table", n::INT AS amounts FROM x
""")
def readable_texts(spark: SparkSession, sf: str) -> DataFrame:
    """TXT14: whether a text shows a title, an article on the tax and a table of amounts."""
    k, money = F.col("o_orderkey") % 4, F.concat(F.lit(" $"), F.format_number("o_totalprice", 2))
    title = F.concat(F.lit("LEY DE INGRESOS DEL MUNICIPIO DE CUST_"), F.col("o_custkey").cast("string"), F.lit(".\n"))
    article = F.lit("Artículo 12. Los predios pagan el Impuesto Predial:\n")
    t = F.when(k == 0, F.concat(title, money)).when(k == 1, F.concat(title, article, F.repeat(money, 5))).when(k == 2, F.concat(article, F.repeat(money, 4)))
    return table(spark, sf, "orders").select("o_orderkey", reports.readable(t).alias("r")).select("o_orderkey", "r.*")


@query("""
SELECT p_partkey, upper(p_name[1]) || lower(p_name[2:position(' ' IN p_name)]) || CASE p_partkey % 3 WHEN 0 THEN 'de ' WHEN 1 THEN 'del ' ELSE 'y ' END || upper(split_part(p_name, ' ', 2)[1]) || lower(split_part(p_name, ' ', 2)[2:]) AS name FROM part
""")
def tidied_names(spark: SparkSession, sf: str) -> DataFrame:
    """STR20: names of headings without their state, in capitals as names are written."""
    link = F.when(F.col("p_partkey") % 3 == 0, " DE ").when(F.col("p_partkey") % 3 == 1, " DEL ").otherwise(" Y ")
    end = F.when(F.col("p_partkey") % 2 == 0, ", YUCATÁN").otherwise(" Yucatan ")
    raw = F.concat(F.lit("  "), F.upper(F.split_part("p_name", F.lit(" "), F.lit(1))), link, F.upper(F.split_part("p_name", F.lit(" "), F.lit(2))), F.lit("., "), end)
    return table(spark, sf, "part").select("p_partkey", reports.tidy_name(raw, "YUCAT[AÁ]N").alias("name"))


@query("""
WITH l AS (SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
c AS (SELECT user_id, CASE WHEN event_type IN ('view', 'click') THEN '' ELSE event_type END AS decision, CASE WHEN user_id % 4 = 0 THEN 'closed' ELSE 'open' END AS status, CASE WHEN event_id % 3 = 0 THEN 'p-01' ELSE 'p-02' END AS p FROM l)
SELECT 'pattern' AS selector, user_id FROM c WHERE p = 'p-01' UNION ALL SELECT 'pending', user_id FROM c WHERE decision = '' UNION ALL SELECT 'reviewed', user_id FROM c WHERE decision <> '' AND status <> 'closed'
UNION ALL SELECT 'explicit', user_id FROM c WHERE user_id IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT 'pattern, pending', user_id FROM c WHERE p = 'p-01' AND decision = ''
""")
def selected_cases(spark: SparkSession, sf: str) -> DataFrame:
    """OTH38: cases to process again: of a pattern, pending, reviewed, named, and by two selectors at once."""
    from panelspark.operators.review import latest_decisions

    last = latest_decisions(table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id")
    cases = last.select("user_id", F.when(F.col("event_type").isin("view", "click"), "").otherwise(F.col("event_type")).alias("decision"), F.when(F.col("user_id") % 4 == 0, "closed").otherwise("open").alias("status"), F.array(F.when(F.col("event_id") % 3 == 0, "p-01").otherwise("p-02")).alias("patterns"))
    named = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("user_id"))
    picks = {"pattern": {"pattern": "p-01"}, "pending": {"pending": True}, "reviewed": {"reviewed": True}, "explicit": {"explicit": named}, "pattern, pending": {"pattern": "p-01", "pending": True}}
    out = None
    for name, how in picks.items():
        rows = reports.selected(cases, "user_id", **how).select(F.lit(name).alias("selector"), "user_id")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(f"""
WITH hits AS ({document_queries.SQL["scheme_detectors"]}), k AS (SELECT DISTINCT l_orderkey, l_orderkey % 7 AS k FROM lineitem),
d(detector, ks) AS (VALUES ('mixto_monocolumna_cuotafija', [0]), ('remite_a_ley_externa', [1]), ('otro_no_clasificado', [1]), ('bracket_superior_cerrado', [4]), ('tarifa_millar_factor', [3]), ('tasa_unica_unidad_factor', [2]), ('desc_transitorios', [0, 1, 2, 3, 4, 5, 6]), ('cuota_es_minimo', [5])),
n AS (SELECT detector, count(*) AS denominator FROM d JOIN k ON list_contains(ks, k.k) GROUP BY 1), c AS (SELECT detector, count(DISTINCT l_orderkey) AS cases FROM hits GROUP BY 1)
SELECT detector, denominator, coalesce(cases, 0) AS cases, round(100.0 * coalesce(cases, 0) / denominator, 4) AS pct FROM n LEFT JOIN c USING (detector)
""")
def scheme_prevalence(spark: SparkSession, sf: str) -> DataFrame:
    """AGG19: how often each rule on documents fires, of the documents of the schemes it looks at."""
    hits = document_queries.scheme_detectors(spark, sf).select("l_orderkey", "detector").distinct()
    k = F.col("l_orderkey") % 7
    of = {"mixto_monocolumna_cuotafija": [0], "remite_a_ley_externa": [1], "otro_no_clasificado": [1], "bracket_superior_cerrado": [4], "tarifa_millar_factor": [3], "tasa_unica_unidad_factor": [2], "desc_transitorios": list(range(7)), "cuota_es_minimo": [5]}
    docs = table(spark, sf, "lineitem").select("l_orderkey").distinct().join(hits.groupBy("l_orderkey").agg(F.collect_set("detector").alias("fired")), "l_orderkey", "left")
    fired = F.coalesce("fired", F.array().cast("array<string>"))
    return aggregates.prevalence(docs, {name: (k.isin(ks), F.array_contains(fired, name)) for name, ks in of.items()})
