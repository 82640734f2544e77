"""Queries on laws and sections found over lines and pages, review books, and what follows from decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import dispatch, laws, segment
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


_LINES = r"""l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INT AS line_no FROM documents)"""

LAW = laws.LawPatterns(
    title=r"(?i)of\s+the\s+([a-z]+)(?:\s+(in|on|to)\s)?", year=r"(?i)(?:^|\s)(is|was|it)\s+(?:the|a)(?:\s|$)", needed=r"(?i)(?:^|\s)that\s+[a-z]", refused=r"(?i)with\s+the",
    window=3, year_ahead=4, needed_ahead=4, look_back=2, apart=3,
)


@query(
    "WITH RECURSIVE " + _LINES + r""",
x AS (SELECT doc_id, line_no, line, lead(line) OVER w AS nxt, CASE WHEN lead(line) OVER w IS NULL THEN line ELSE line || chr(10) || lead(line) OVER w END AS two,
  concat_ws(' ', nullif(regexp_replace(line, '^\s+|\s+$', '', 'g'), ''), nullif(regexp_replace(lead(line) OVER w, '^\s+|\s+$', '', 'g'), ''), nullif(regexp_replace(lead(line, 2) OVER w, '^\s+|\s+$', '', 'g'), '')) AS t
  FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
h AS (SELECT *, regexp_matches(line, '(?i)(?:^|\s)that\s+[a-z]') AS n1, NOT regexp_matches(line, '(?i)(?:^|\s)that\s+[a-z]') AND regexp_matches(two, '(?i)(?:^|\s)that\s+[a-z]') AND NOT coalesce(regexp_matches(nxt, '(?i)(?:^|\s)that\s+[a-z]'), false) AS n2,
  regexp_matches(line, '(?i)with\s+the') AS r1, NOT regexp_matches(line, '(?i)with\s+the') AND regexp_matches(two, '(?i)with\s+the') AND NOT coalesce(regexp_matches(nxt, '(?i)with\s+the'), false) AS r2,
  regexp_matches(line, '(?i)(?:^|\s)(is|was|it)\s+(?:the|a)(?:\s|$)') AS m1, regexp_matches(two, '(?i)(?:^|\s)(is|was|it)\s+(?:the|a)(?:\s|$)') AS m2, coalesce(regexp_matches(nxt, '(?i)(?:^|\s)(is|was|it)\s+(?:the|a)(?:\s|$)'), false) AS m3 FROM x),
y AS (SELECT *, CASE WHEN m1 THEN regexp_extract(line, '(?i)(?:^|\s)(is|was|it)\s+(?:the|a)(?:\s|$)', 1) END AS y1, CASE WHEN NOT m1 AND m2 AND NOT m3 THEN regexp_extract(two, '(?i)(?:^|\s)(is|was|it)\s+(?:the|a)(?:\s|$)', 1) END AS y2 FROM h),
z AS (SELECT doc_id, line_no, t, coalesce(first_value(coalesce(y1, y2) IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), first_value(y1 IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING), '') AS y,
  coalesce(bool_or(n1) OVER (w ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING), false) OR coalesce(bool_or(n2) OVER (w ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), false) AS needed,
  coalesce(bool_or(r1) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), false) OR coalesce(bool_or(r2) OVER (w ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), false) AS refused
  FROM y WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
c AS (SELECT doc_id, line_no, regexp_extract(t, '(?i)of\s+the\s+([a-z]+)(?:\s+(in|on|to)\s)?', 1) AS name, coalesce(nullif(regexp_extract(t, '(?i)of\s+the\s+([a-z]+)(?:\s+(in|on|to)\s)?', 2), ''), y) AS year FROM z WHERE needed AND NOT refused AND regexp_matches(t, '(?i)of\s+the\s+([a-z]+)')),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS i, row_number() OVER (PARTITION BY doc_id, lower(name), year ORDER BY line_no) > 1 AS again FROM c),
f AS (SELECT doc_id, i, line_no, name, year, true AS fresh, line_no AS last FROM o WHERE i = 1
  UNION ALL SELECT o.doc_id, o.i, o.line_no, o.name, o.year, NOT o.again OR o.line_no - f.last >= 3, CASE WHEN NOT o.again OR o.line_no - f.last >= 3 THEN o.line_no ELSE f.last END FROM f JOIN o ON o.doc_id = f.doc_id AND o.i = f.i + 1)
SELECT doc_id, line_no, name, year FROM f WHERE fresh"""
)
def laws_over_lines(spark: SparkSession, sf: str) -> DataFrame:
    """TXT03: titles over three lines, with what must follow and may not precede them, apart from what was seen before."""
    return laws.laws(segment.lines(table(spark, sf, "documents"), "doc_id", "text"), "doc_id", LAW)


@query(r"""WITH d AS (SELECT doc_id, text, ['the', 'is', 'was'][doc_id % 3 + 1] AS name FROM documents),
b AS (SELECT *, CASE WHEN regexp_matches(text, '(?i)(?:that|it)\s+[a-z]+') THEN length(regexp_extract(text, '(?is)^(.*?)(?:that|it)\s+[a-z]+', 1)) ELSE 0 END AS body FROM d),
s AS (SELECT *, CASE WHEN regexp_matches(text, '(?i)(?:that|it)\s+' || name) THEN length(regexp_extract(text, '(?is)^(.*?)(?:that|it)\s+' || name, 1)) END AS strict, substr(text, body + 1) AS rest FROM b),
x AS (SELECT *, CASE WHEN regexp_matches(rest, '(?i)of\s+' || name) THEN body + length(regexp_extract(rest, '(?is)^(.*?)of\s+' || name, 1)) END AS lax FROM s),
h AS (SELECT *, coalesce(strict, lax) AS start, CASE WHEN strict IS NOT NULL THEN length(regexp_extract(text, '(?i)(?:that|it)\s+' || name)) ELSE length(regexp_extract(rest, '(?i)of\s+' || name)) END AS head FROM x),
t AS (SELECT *, substr(text, start + head + 1) AS tail FROM h WHERE start IS NOT NULL)
SELECT doc_id, name, start::INT AS start, (CASE WHEN regexp_matches(tail, '(?i)(?:that|it)\s+[a-z]+') THEN start + head + length(regexp_extract(tail, '(?is)^(.*?)(?:that|it)\s+[a-z]+', 1)) WHEN regexp_matches(tail, '(?i)of\s+[a-z]+') THEN start + head + length(regexp_extract(tail, '(?is)^(.*?)of\s+[a-z]+', 1)) ELSE length(text) END)::INT AS "end" FROM t""")
def law_spans(spark: SparkSession, sf: str) -> DataFrame:
    """TXT05: the span of a name's law between headers; a loose header in the summary doesn't count."""
    name = F.get(F.array(F.lit("the"), F.lit("is"), F.lit("was")), (F.col("doc_id") % 3).cast("int"))
    d = table(spark, sf, "documents").select("doc_id", "text", name.alias("name"))
    span = laws.law_span(F.col("text"), F.col("name"), r"(?i)(?:that|it)\s+", r"(?i)of\s+", "[a-z]+")
    return d.select("doc_id", "name", span.alias("s")).filter("s IS NOT NULL").select("doc_id", "name", "s.start", "s.end")


PAGE = laws.PagePatterns(
    full="the [a-z]+ of", short="^[a-z]+ (is|are)", section="(^| )(it|that)( |$)", chapter="(^| )and( |$)", matter="(^| )was( |$)", parent="from the", article="(^| )for( |$)",
    ruled_out="^by the", following="(^| )with( |$)", following_start="^[a-m]", short_most=60, following_most=400, context=2, top=2, forced=3,
)


@query("WITH " + _LINES + r""",
n AS (SELECT doc_id, max(line_no // 3) + 1 AS pages FROM l GROUP BY doc_id),
x AS (SELECT doc_id, line_no // 3 AS page, line_no, trim(regexp_replace(lower(line), '\s+', ' ', 'g')) AS line FROM l),
y AS (SELECT *, lag(line) OVER w AS prev, row_number() OVER w <= 2 AS top, coalesce(bool_or(regexp_matches(line, '(^| )(it|that)( |$)')) OVER (w ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), false) AS near,
  regexp_matches(line, 'the [a-z]+ of') AS is_full FROM x WHERE line <> '' WINDOW w AS (PARTITION BY doc_id, page ORDER BY line_no)),
p AS (SELECT doc_id, page, bool_or((is_full OR regexp_matches(line, '^[a-z]+ (is|are)') AND length(line) <= 60) AND near) AS strong, bool_or(is_full) AS full_, bool_or(regexp_matches(line, 'from the')) AS parent, bool_or(regexp_matches(line, '(^| )and( |$)')) AS chapter,
  bool_or(regexp_matches(line, '(^| )was( |$)')) AS matter, bool_or(regexp_matches(line, '(^| )for( |$)')) AS article, bool_or(regexp_matches(line, '^by the') AND top) AS out_,
  bool_or(regexp_matches(line, '(^| )with( |$)') AND length(line) <= 400 AND (regexp_matches(line, '^[a-m]') OR coalesce(regexp_matches(prev, '(^| )and( |$)') OR regexp_matches(prev, '(^| )(it|that)( |$)'), false))) AS next_ FROM y GROUP BY 1, 2),
c AS (SELECT *, NOT out_ AND (strong OR full_ AND (parent OR chapter AND matter)) AND (article OR coalesce(lead(page) OVER w = page + 1 AND lead(article) OVER w, false)) AS core FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY page)),
f AS (SELECT *, min(CASE WHEN core THEN page END) OVER (PARTITION BY doc_id) AS first_ FROM c),
g AS (SELECT doc_id, any_value(first_) AS first_, min(CASE WHEN next_ AND page > first_ THEN page END) AS next_ FROM f GROUP BY 1),
r AS (SELECT n.doc_id, pages, first_, next_, CASE WHEN next_ IS NOT NULL THEN next_ - 1 ELSE CASE WHEN first_ IS NOT NULL THEN least(pages - 1, first_ + 3) END END AS last_ FROM n LEFT JOIN g USING (doc_id))
SELECT doc_id, pages::BIGINT AS pages, first_::BIGINT AS first, last_::BIGINT AS last, next_::BIGINT AS "next", CASE WHEN first_ IS NOT NULL THEN next_ IS NULL END AS forced, CASE WHEN first_ IS NOT NULL THEN next_ IS NULL OR last_ - first_ + 1 <= 2 END AS expanded,
  CASE WHEN first_ IS NULL THEN 0.0 WHEN next_ IS NULL THEN 0.3 ELSE 1.0 END::DOUBLE AS confidence FROM r""")
def page_sections(spark: SparkSession, sf: str) -> DataFrame:
    """TXT06, TXT07: the pages of a section by headers, lines before them and articles on the next page; pages of three lines."""
    x = segment.lines(table(spark, sf, "documents"), "doc_id", "text").withColumn("page", F.expr("line_no div 3"))
    return laws.page_sections(x, "doc_id", PAGE)


def _books(spark: SparkSession, sf: str) -> DataFrame:
    """A review book for each order: a pattern, a filled case and an open one."""
    o, lit = table(spark, sf, "orders"), F.lit
    year, k = F.year("o_orderdate"), F.col("o_orderkey")
    case = lambda y: F.concat(lit("\n### `"), F.lower("o_orderstatus"), lit("_x/cust_"), F.col("o_custkey").cast("string"), lit("/"), y.cast("string"), lit("`  (cvegeo "), F.lpad((k % 1000).cast("string"), 5, "0"), lit(")\n\n"))
    fields = F.concat(
        lit("- **JSON**: [`docs/"), k.cast("string"), lit(".json`](x)\n- **tipo actual** (antes): `"), F.col("o_orderstatus"), lit("`\n\n- ["), F.when(k % 3 == 0, lit("x ")).when(k % 3 == 1, lit("X")).otherwise(lit(" ")),
        lit("] revisado\n- veredicto: "), F.when(k % 2 == 0, lit("Correct.")).otherwise(lit("Inválido")), lit("\n- tipo_correcto: TIPO "), F.col("o_orderstatus"), lit("\n- causa_raiz: segmetacion, otra\n- patron: ver p-0"), (k % 10).cast("string"), lit("\n- notas: "), F.col("o_orderpriority"), lit("\n- accion: \n"),
    )
    head = F.concat(lit("# Libro\n\n## Patrones detectados\n\n### P-0"), (k % 10).cast("string"), lit(" uno\n- **diagnostico**: "), F.col("o_orderpriority"), lit("\n- **casos**: "), k.cast("string"), lit("\n\n## Casos\n"))
    return o.select(k, F.concat(head, case(year), fields, case(year + 1), lit("- veredicto:\n- notas:\n")).alias("text"))


@query("""SELECT o_orderkey, u.n::INT AS n, lower(o_orderstatus) || '_x' AS estado, 'cust_' || o_custkey AS slug, (year(o_orderdate) + u.n - 2)::INT AS anio, lpad((o_orderkey % 1000)::VARCHAR, 5, '0') AS cvegeo,
  CASE WHEN u.n = 2 THEN 'docs/' || o_orderkey || '.json' ELSE '' END AS json_rel, CASE WHEN u.n = 2 THEN o_orderstatus ELSE '' END AS tipo_actual, u.n = 2 AND o_orderkey % 3 < 2 AS revisado,
  CASE WHEN u.n = 3 THEN '' WHEN o_orderkey % 2 = 0 THEN 'correcto' ELSE 'invalido' END AS veredicto, CASE WHEN u.n = 2 THEN 'tipo ' || lower(o_orderstatus) ELSE '' END AS tipo_correcto, CASE WHEN u.n = 2 THEN 'segmentacion' ELSE '' END AS causa_raiz,
  CASE WHEN u.n = 2 THEN 'P-0' || o_orderkey % 10 ELSE '' END AS patron, CASE WHEN u.n = 2 THEN o_orderpriority ELSE '' END AS notas, '' AS accion FROM orders, (VALUES (2), (3)) u(n)""")
def review_book_cases(spark: SparkSession, sf: str) -> DataFrame:
    """TXT16: cases of review books in Markdown: header, check box, fields, misspellings put right."""
    return laws.book_cases(_books(spark, sf), "o_orderkey", "text")


@query("SELECT o_orderkey, 'P-0' || o_orderkey % 10 AS patron, o_orderpriority AS diagnostico, '' AS fix_propuesto, '' AS prioridad, '' AS estado, o_orderkey::VARCHAR AS casos FROM orders")
def review_book_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """TXT16: patterns of review books."""
    return laws.book_patterns(_books(spark, sf), "o_orderkey", "text")


@query(r"""WITH p AS (SELECT doc_id, text, regexp_matches(text, '(?i)the\s+[a-z]+\s+of') AS m, length(regexp_extract(text, '(?is)^(.*?)the\s+[a-z]+\s+of', 1)) AS a FROM documents),
q AS (SELECT *, substr(text, a + 21) AS tail FROM p), r AS (SELECT *, regexp_matches(tail, '(?i)that\s+[a-z]') AS e, length(regexp_extract(tail, '(?is)^(.*?)that\s+[a-z]', 1)) AS b FROM q),
s AS (SELECT doc_id, text, regexp_replace(substr(text, a + 1, CASE WHEN e THEN 20 + b ELSE 400 END), '^\s+|\s+$', '', 'g') AS s, m FROM r), t AS (SELECT doc_id, text, CASE WHEN m AND length(s) >= 50 THEN s END AS one FROM s),
p2 AS (SELECT doc_id, one, text, regexp_matches(text, '(?i)in\s+the') AS m, length(regexp_extract(text, '(?is)^(.*?)in\s+the', 1)) AS a FROM t),
q2 AS (SELECT *, substr(text, a + 21) AS tail FROM p2), r2 AS (SELECT *, regexp_matches(tail, '(?i)was\s+[a-z]') AS e, length(regexp_extract(tail, '(?is)^(.*?)was\s+[a-z]', 1)) AS b FROM q2),
s2 AS (SELECT doc_id, one, regexp_replace(substr(text, a + 1, CASE WHEN e THEN 20 + b ELSE 400 END), '^\s+|\s+$', '', 'g') AS s, m FROM r2), t2 AS (SELECT doc_id, one, CASE WHEN m AND length(s) >= 50 THEN s END AS two FROM s2)
SELECT doc_id, CASE WHEN regexp_matches(one, '(?i)for\s') AND regexp_matches(one, '(?i)is\s') THEN one WHEN length(two) > coalesce(length(one), 0) THEN two ELSE one END AS section FROM t2""")
def special_tariff_section(spark: SparkSession, sf: str) -> DataFrame:
    """OTH28: a tariff section with a check of its numbers, and the one of another reading where that is longer."""
    one = laws.tariff_section(F.col("text"), r"(?i)the\s+[a-z]+\s+of", r"(?i)that\s+[a-z]", most=400)
    two = laws.tariff_section(F.col("text"), r"(?i)in\s+the", r"(?i)was\s+[a-z]", most=400)
    d = table(spark, sf, "documents").select("doc_id", one.alias("one"), two.alias("two"))
    return d.select("doc_id", laws.with_fallback(F.col("one"), F.col("two"), [r"(?i)for\s", r"(?i)is\s"]).alias("section"))


#: Headers of an index, its hits, and the year after a hit.
INDEX = (r"(?m)^([A-Z][a-z]+) ", r"of the ([a-z]+)", r"(?:is|was) ([a-z]+)", 60)


@query()
def index_hits(spark: SparkSession, sf: str) -> DataFrame:
    """OTH19: hits of an index in blocks under headers, each with the year in the characters after it."""
    return laws.index_hits(table(spark, sf, "documents"), "doc_id", "text", *INDEX)


def _decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as a decision on a customer and year."""
    e, k = table(spark, sf, "events"), F.col("event_id")
    names = F.array(*[F.lit(x) for x in ("confirmar_ok", " Propagar_Previo", "corregir_previo", "reextraer", "re_segmentar", "sin_ley", "ignorar", "", "otra")])
    step = F.expr("event_id div 9")
    notes = F.when(step % 4 == 0, "paginas=20-22; pdf=a/b.pdf").when(step % 4 == 1, "force_vision=Yes; hint_tipo=F").when(step % 4 == 2, "sin datos")
    return e.select(k.alias("id"), F.col("user_id").alias("entity"), (1995 + step % 7).cast("long").alias("year"), F.get(names, (k % 9).cast("int")).alias("decision"), F.when(F.col("value") > 50, "Cambio_menor").otherwise("").alias("option"), notes.alias("notes"))


_ROUTED = """d AS (SELECT event_id AS id, user_id AS entity, (1995 + event_id // 9 % 7)::BIGINT AS year, ['confirmar_ok', 'propagar_previo', 'corregir_previo', 'reextraer', 're_segmentar', 'sin_ley', 'ignorar', '', 'otra'][event_id % 9 + 1] AS decision,
  CASE WHEN value > 50 THEN 'cambio_menor' ELSE '' END AS option, CASE event_id // 9 % 4 WHEN 0 THEN 'paginas=20-22; pdf=a/b.pdf' WHEN 1 THEN 'force_vision=Yes; hint_tipo=F' WHEN 2 THEN 'sin datos' END AS notes, event_id // 9 % 4 AS s FROM events),
c AS (SELECT DISTINCT o_custkey AS entity, year(o_orderdate)::BIGINT AS year FROM orders),
j AS (SELECT d.*, h.entity IS NOT NULL AS has, b.entity IS NOT NULL AS had FROM d LEFT JOIN c h ON h.entity = d.entity AND h.year = d.year LEFT JOIN c b ON b.entity = d.entity AND b.year = d.year - 1),
o AS (SELECT *, CASE WHEN decision = '' THEN 'undecided' WHEN decision = 'otra' THEN 'invalid' WHEN decision = 'propagar_previo' AND NOT (has AND had) OR decision = 'corregir_previo' AND NOT has OR decision = 're_segmentar' AND s <> 0 THEN 'error' ELSE 'done' END AS outcome FROM j),
r AS (SELECT id, entity, year, decision, option, notes, outcome,
  CASE WHEN outcome = 'done' THEN CASE WHEN decision = 'confirmar_ok' AND option = 'cambio_menor' THEN 'confirmado_cambio_menor' ELSE CASE decision WHEN 'confirmar_ok' THEN 'confirmado_fiel' WHEN 'propagar_previo' THEN 'propagado_previo' WHEN 'corregir_previo' THEN 'corregido_previo' WHEN 'reextraer' THEN 'reextraido' WHEN 're_segmentar' THEN 'resegmentado' WHEN 'sin_ley' THEN 'sin_ley' ELSE 'ignorado' END END END AS origin,
  CASE WHEN outcome = 'done' THEN CASE decision WHEN 'propagar_previo' THEN year - 1 WHEN 'corregir_previo' THEN year END END AS copy_from, CASE WHEN outcome = 'done' THEN CASE decision WHEN 'propagar_previo' THEN year WHEN 'corregir_previo' THEN year - 1 END END AS copy_to,
  CASE WHEN outcome = 'done' AND decision IN ('reextraer', 're_segmentar') AND s = 0 THEN '20-22' END AS pages, CASE WHEN outcome = 'done' AND decision IN ('reextraer', 're_segmentar') AND s = 0 THEN 'a/b.pdf' END AS pdf,
  CASE WHEN decision = 'reextraer' AND s = 1 THEN 'F' END AS hint_type, decision = 'reextraer' AND s = 1 AS force_vision, CASE WHEN outcome = 'done' AND decision IN ('reextraer', 're_segmentar') THEN notes END AS hint,
  outcome = 'done' AND option = 'cambio_menor' AND decision IN ('confirmar_ok', 'propagar_previo', 'corregir_previo') AS minor, decision = 'sin_ley' AND has AS closes FROM o)"""


def _routes(spark: SparkSession, sf: str) -> DataFrame:
    cells = table(spark, sf, "orders").select(F.col("o_custkey").alias("entity"), F.year("o_orderdate").cast("long").alias("year")).distinct()
    return dispatch.routed(_decisions(spark, sf), cells)


@query("WITH " + _ROUTED + " SELECT * FROM r")
def decision_routes(spark: SparkSession, sf: str) -> DataFrame:
    """HIL04: the seven decisions with what each asks for: copies, edits, page overrides, extraction, closing, or an error."""
    return _routes(spark, sf)


@query("WITH " + _ROUTED + """ SELECT 'log' AS output, decision, count(*)::BIGINT AS n FROM r WHERE outcome = 'done' GROUP BY 2 UNION ALL SELECT 'copies', decision, count(*) FROM r WHERE copy_to IS NOT NULL GROUP BY 2 UNION ALL SELECT 'edits', decision, count(*) FROM r WHERE minor GROUP BY 2
UNION ALL SELECT 'overrides', decision, count(*) FROM r WHERE pages IS NOT NULL GROUP BY 2 UNION ALL SELECT 'queue', decision, count(*) FROM r WHERE outcome = 'done' AND decision IN ('reextraer', 're_segmentar') GROUP BY 2 UNION ALL SELECT 'closed', decision, count(*) FROM r WHERE closes GROUP BY 2
UNION ALL SELECT 'failures', decision, count(*) FROM r WHERE outcome IN ('error', 'invalid') GROUP BY 2""")
def decision_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """HIL04: how many rows of each decision each of the seven outputs gets."""
    return _routes(spark, sf).select(F.explode(dispatch.output_names()).alias("output"), "decision").groupBy("output", "decision").agg(F.count("*").alias("n"))


def _audited(spark: SparkSession, sf: str) -> DataFrame:
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    decision = F.when(F.col("o_orderpriority") == "1-URGENT", "exclude_muni").when(F.col("o_orderpriority") == "2-HIGH", "accept_as_is").when(F.col("o_orderpriority") == "3-MEDIUM", "real_reform").when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Extraction_error").otherwise("")
    right = F.when(F.col("o_totalprice") > 250000, F.col("o_orderstatus"))
    result = dispatch.audit_result(decision, right, F.when(k % 3 == 0, "a.pdf"), F.when(k % 2 == 0, "3-5"), F.when(k % 5 == 0, "Asumir el\nvalor anterior"), F.col("o_custkey") % 10 != 0)
    return o.select(k, "o_custkey", result.alias("result"))


_AUDITED = """a AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'undecided' WHEN o_custkey % 10 = 0 THEN 'incomplete' WHEN o_orderpriority = '1-URGENT' THEN 'excluded' WHEN o_orderpriority = '2-HIGH' THEN 'accepted'
  WHEN o_orderpriority = '3-MEDIUM' THEN CASE WHEN o_totalprice > 250000 THEN 'reform_override' ELSE 'reform' END WHEN o_orderkey % 6 = 0 THEN 'reextract' WHEN o_orderkey % 5 = 0 THEN 'impute_previous' WHEN o_totalprice > 250000 THEN 'override' ELSE 'no_action' END AS result FROM orders)"""


@query("WITH " + _AUDITED + " SELECT * FROM a")
def audit_results(spark: SparkSession, sf: str) -> DataFrame:
    """HIL08: what the four decisions of a treatment audit lead to."""
    return _audited(spark, sf)


@query("WITH " + _AUDITED + """, l AS (SELECT *, CASE WHEN result = 'excluded' THEN 'excluded' WHEN result LIKE 'reform%' THEN 'real_reform' WHEN result = 'accepted' THEN 'non_absorbing' END AS list FROM a)
SELECT list, o_custkey, max(o_orderkey) AS o_orderkey, arg_max(result, o_orderkey) AS result FROM l WHERE list IS NOT NULL GROUP BY 1, 2""")
def audit_derived_lists(spark: SparkSession, sf: str) -> DataFrame:
    """HIL08: the lists that an audit leads to, with the last row of each entity."""
    return dispatch.audit_lists(_audited(spark, sf), "o_custkey", "o_orderkey")


@query("""WITH o AS (SELECT o_orderkey, year(o_orderdate)::INT AS y, CASE o_orderpriority WHEN '1-URGENT' THEN 'no_existe_ley' WHEN '2-HIGH' THEN 'encontrado' WHEN '3-MEDIUM' THEN 'encontrado' WHEN '4-NOT SPECIFIED' THEN 'otro' ELSE '' END AS s, o_totalprice > 400000 AS real_, o_custkey % 10 <> 0 AS known, o_orderkey % 3 AS a, o_orderkey % 5 AS b FROM orders),
r AS (SELECT *, CASE WHEN s = '' THEN 'undecided' WHEN NOT known THEN 'incomplete' WHEN real_ THEN 'exists' WHEN s = 'no_existe_ley' THEN CASE WHEN a = 0 THEN 'no_law' WHEN y = 1996 THEN 'own_year' ELSE 'impute_from' END WHEN s = 'otro' THEN 'unexpected' WHEN a = 1 OR b = 0 THEN 'no_pages' WHEN b = 1 THEN 'bad_pages' ELSE 'extract' END AS result FROM o)
SELECT o_orderkey, result, CASE WHEN result = 'impute_from' THEN 1996 END::INT AS from_year, CASE WHEN result = 'extract' THEN 47 END::INT AS first_page, CASE WHEN result = 'extract' THEN CASE b WHEN 2 THEN 52 WHEN 3 THEN 49 ELSE 47 END END::INT AS last_page FROM r""")
def reextraction_results(spark: SparkSession, sf: str) -> DataFrame:
    """HIL09: audited gaps to be extracted from given pages, filled from a year, closed without law, or left."""
    o, k, p = table(spark, sf, "orders"), F.col("o_orderkey"), F.col("o_orderpriority")
    status = F.when(p == "1-URGENT", "No_existe_ley").when(p.isin("2-HIGH", "3-MEDIUM"), "encontrado").when(p == "4-NOT SPECIFIED", "otro")
    pages = F.when(k % 5 == 1, "unas").when(k % 5 == 2, "47-52").when(k % 5 == 3, "48, 47 y 49").when(k % 5 == 4, "p.47")
    r = dispatch.reextraction_result(status, F.year("o_orderdate"), F.when(k % 3 != 0, "Imputar  con datos de 1996."), F.when(k % 3 != 1, "a.pdf"), pages, F.col("o_totalprice") > 400000, F.col("o_custkey") % 10 != 0)
    return o.select(k, r.alias("r")).select("o_orderkey", "r.*")


@query("""WITH r AS (SELECT l_orderkey, count(*) FILTER (WHERE l_quantity > 25)::BIGINT AS produced, CASE WHEN min(l_discount) = 0 THEN 'e' || repeat('x', 120) END AS error FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderdate, CASE WHEN o_orderstatus = 'O' THEN 'ok' WHEN r.l_orderkey IS NULL THEN '' WHEN error IS NOT NULL THEN 'error: ' || substr(error, 1, 100) WHEN produced > 0 THEN 'ok' ELSE 'error_sin_output' END AS processed,
  CASE WHEN o_orderstatus = 'O' THEN NULL WHEN r.l_orderkey IS NOT NULL THEN o_orderdate END AS processed_at FROM orders LEFT JOIN r ON l_orderkey = o_orderkey""")
def queue_consumed(spark: SparkSession, sf: str) -> DataFrame:
    """HIL10: pending rows of an extraction queue get their status and time; rows done before stay."""
    queue = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.when(F.col("o_orderstatus") == "O", "ok").otherwise("").alias("processed"), F.lit(None).cast("timestamp").alias("processed_at"))
    failed = F.when(F.min("l_discount") == 0, F.concat(F.lit("e"), F.repeat(F.lit("x"), F.lit(120))))
    results = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.when(F.col("l_quantity") > 25, 1)).alias("produced"), failed.alias("error"))
    return dispatch.consumed(queue.withColumn("processed_at", F.col("processed_at").cast(queue.schema["o_orderdate"].dataType)), results, "o_orderkey", F.col("o_orderdate"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'otro_no_clasificado' WHEN 'O' THEN 'FALTA_PREDIAL' ELSE 'tasa' END AS kind, CASE WHEN o_orderstatus = 'F' THEN 'escape' ELSE 'flagged' END AS list FROM orders
WHERE o_orderpriority <> '5-LOW' AND (o_orderstatus = 'F' OR o_totalprice > 200000)""")
def cases_to_review(spark: SparkSession, sf: str) -> DataFrame:
    """OTH33: documents for the review book: escape types and flagged ones, without synthetic ones."""
    kind = F.when(F.col("o_orderstatus") == "F", "otro_no_clasificado").when(F.col("o_orderstatus") == "P", "tasa")
    o = table(spark, sf, "orders").select("o_orderkey", kind.alias("kind"), F.col("o_orderpriority").alias("model"), (F.col("o_totalprice") > 200000).alias("flagged"))
    return dispatch.cases_to_review(o, "kind", "model", "flagged", ("5-LOW",)).select("o_orderkey", "kind", "list")


@query("SELECT o_orderkey, o_totalprice > 20000 AS valid, bool_and(o_totalprice > 20000) OVER (PARTITION BY o_custkey) AS copied FROM orders")
def corrections_copied(spark: SparkSession, sf: str) -> DataFrame:
    """OTH34: corrected documents checked; a batch with an error is not copied."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return dispatch.corrections(o, F.col("o_totalprice") > 20000, "o_custkey").select("o_orderkey", "valid", "copied")


@query("SELECT event_id, CASE event_type WHEN 'error' THEN 're_run' WHEN 'click' THEN 're_segment' ELSE 're_extract' END AS repair FROM events WHERE event_type IN ('error', 'click', 'view', 'signup')")
def audit_repairs(spark: SparkSession, sf: str) -> DataFrame:
    """OTH41: the repair that an audit row asks for."""
    kinds = {"re_extract": ["view", "signup"], "re_segment": ["click"], "re_run": ["error"]}
    return dispatch.repairs(table(spark, sf, "events").select("event_id", "event_type"), F.col("event_type"), kinds).select("event_id", "repair")


def _attempt(c: str) -> Column:
    return F.coalesce(F.length(c), F.lit(0))


@query("""WITH a AS (SELECT conv_id, turn, CASE WHEN coalesce(length(text), 0) % 4 = 0 THEN text END AS out_, role, coalesce(length(text), 0)::BIGINT AS n FROM conversations),
s AS (SELECT conv_id, min(turn) FILTER (WHERE out_ IS NOT NULL) AS stage FROM a GROUP BY 1), r AS (SELECT a.*, s.stage FROM a JOIN s USING (conv_id) WHERE s.stage IS NULL OR turn <= s.stage)
SELECT conv_id, any_value(stage) AS stage, min(out_) AS output, count(*)::BIGINT AS tried, sum(n)::BIGINT AS cost, coalesce(string_agg('e' || turn || '=' || role, '; ' ORDER BY turn) FILTER (WHERE out_ IS NULL), '') AS history, any_value(stage) IS NULL AS review FROM r GROUP BY 1""")
def extraction_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """OTH12: the first stage of a cascade with an output, what was spent up to it, and the errors before it."""
    c = table(spark, sf, "conversations")
    attempts = c.select("conv_id", "turn", F.when(_attempt("text") % 4 == 0, F.col("text")).alias("out"), "role", _attempt("text").cast("long").alias("n"))
    return dispatch.cascade(attempts, "conv_id", "turn", "out", "role", "n")
