"""Queries on panels: assembly, joins, neighbours, imputation, changes, trajectories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.functions import numeric, text
from panelspark.operators import aggregates, change, joins, panel
from panelspark.plans.tables import CELLS, IMPUTED, OBS, YEARS, cells, observations, order_rows, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"WITH {OBS} SELECT * FROM obs")
def panel_dedupe_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """AGG15, SET01, OTH01: one row for each entity and year, the first in an explicit order."""
    return observations(spark, sf)


@query("SELECT c_custkey, c_name, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def catalog_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    """JON01, JON02, OTH05."""
    c, n, r = table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "region")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left").select("c_custkey", "c_name", "n_name", "r_name")


@query("""
SELECT s_suppkey, coalesce(a.v, b.v) AS c_custkey, CASE WHEN a.v IS NOT NULL THEN 'first' WHEN b.v IS NOT NULL THEN 'second' ELSE 'none' END AS matched_by
FROM supplier LEFT JOIN (SELECT round(c_acctbal)::BIGINT AS k, min(c_custkey) AS v FROM customer WHERE c_acctbal IS NOT NULL GROUP BY 1) a ON round(s_acctbal)::BIGINT = a.k
LEFT JOIN (SELECT c_nationkey AS k, min(c_custkey) AS v FROM customer WHERE c_nationkey IS NOT NULL GROUP BY 1) b ON s_nationkey = b.k
""")
def fallback_two_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """JON03, JON04, OTH04: by the first key, else by the second."""
    s = table(spark, sf, "supplier").withColumn("k1", F.round("s_acctbal").cast("long"))
    c = table(spark, sf, "customer").withColumn("c1", F.round("c_acctbal").cast("long"))
    return joins.fallback_join(s.select("s_suppkey", "k1", "s_nationkey"), c, ("k1", "c1"), ("s_nationkey", "c_nationkey"), "c_custkey").select("s_suppkey", "c_custkey", "matched_by")


@query(f"""WITH {CELLS}, g AS (SELECT c_custkey AS entity, c_nationkey AS nation, y.year FROM customer CROSS JOIN (SELECT unnest(range(1995, 2002))::BIGINT AS year) y)
SELECT nation, g.year, count(*)::BIGINT AS ideal, count(o.entity)::BIGINT AS raw, round(100.0 * count(o.entity) / count(*), 4) AS raw_pct FROM g LEFT JOIN obs o ON o.entity = g.entity AND o.year = g.year GROUP BY nation, g.year""")
def coverage_grid_left_join(spark: SparkSession, sf: str) -> DataFrame:
    """JON05, AGG05, HIL06: catalog by year, left joined to facts."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_nationkey").alias("nation"))
    seen = observations(spark, sf).select("entity", "year", F.lit(True).alias("observed"))
    x = joins.grid(c, YEARS).join(seen, ["entity", "year"], "left").withColumn("observed", F.coalesce("observed", F.lit(False)))
    return panel.coverage(x, ["nation", "year"]).select("nation", "year", "ideal", "raw", "raw_pct")


@query(f"WITH {OBS} SELECT c_custkey AS entity, y.year FROM customer CROSS JOIN (SELECT unnest(range(1995, 2002))::BIGINT AS year) y WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.entity = c_custkey AND o.year = y.year)")
def missing_cells_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    """JON07, OTH14, OTH31."""
    return joins.missing_cells(table(spark, sf, "customer").select(F.col("c_custkey").alias("entity")), observations(spark, sf), YEARS)


@query("SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal > 0) AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_suppkey AND p_size > 25)")
def fact_not_in_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """JON06, JON08, SET03, SET07: neither in the catalog nor an alias."""
    facts = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    cat = table(spark, sf, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    alias = table(spark, sf, "part").filter("p_size > 25").select(F.col("p_partkey").alias("l_suppkey"))
    return joins.not_in_catalog(facts, cat, "l_suppkey", alias).select("l_orderkey", "l_linenumber", "l_suppkey")


@query("""
WITH a AS (SELECT o_custkey AS k, o_orderstatus AS t FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) rn FROM orders WHERE o_totalprice > 200000) WHERE rn = 1),
b AS (SELECT o_custkey AS k, o_orderstatus AS t FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) rn FROM orders WHERE o_orderpriority <> '1-URGENT') WHERE rn = 1)
SELECT coalesce(a.k, b.k) AS entity, a.t AS a_tipo, b.t AS b_tipo, CASE WHEN a.k IS NULL THEN 'right_only' WHEN b.k IS NULL THEN 'left_only' ELSE 'both' END AS side,
  CASE WHEN a.t IS NULL OR b.t IS NULL THEN 'unpaired' WHEN a.t <> 'O' AND b.t = 'O' THEN 'regression' WHEN a.t = 'O' AND b.t <> 'O' THEN 'gain' WHEN a.t <> b.t THEN 'changed' ELSE 'same' END AS flag
FROM a FULL OUTER JOIN b ON a.k = b.k
""")
def full_outer_corpus_diff(spark: SparkSession, sf: str) -> DataFrame:
    """JON09, JON10, DET19, DET20, SET02: two versions of a corpus side by side."""
    from panelspark.operators.documents import corpus_comparison_flags

    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("entity"), F.col("o_orderstatus").alias("tipo"), "o_orderkey", "o_totalprice", "o_orderpriority")
    a = panel.keep_first(o.filter("o_totalprice > 200000"), ["entity"], [F.col("o_orderkey")])
    b = panel.keep_last(o.filter("o_orderpriority <> '1-URGENT'"), ["entity"], [F.col("o_orderkey")])
    return joins.full_comparison(a, b, ["entity"], ["tipo"]).withColumn("flag", corpus_comparison_flags(F.col("a_tipo"), F.col("b_tipo"), "O"))


@query(f"WITH {CELLS} SELECT entity, year, observed, py AS prev_year, ny AS next_year, pt AS prev_tipo, nt AS next_tipo FROM vals")
def asof_prev_next_year(spark: SparkSession, sf: str) -> DataFrame:
    """JON13, WIN06: nearest observed years on both sides of every cell."""
    x = panel.with_neighbours(cells(spark, sf), ["tipo", "rangos"])
    return x.select("entity", "year", "observed", F.col("prev.y").alias("prev_year"), F.col("next.y").alias("next_year"), F.col("prev.tipo").alias("prev_tipo"), F.col("next.tipo").alias("next_tipo"))


@query(f"""WITH {CELLS} SELECT entity, year, observed, CASE WHEN observed THEN tipo WHEN py IS NOT NULL AND (ny IS NULL OR year - py <= ny - year) THEN pt ELSE nt END AS tipo,
CASE WHEN observed THEN year WHEN py IS NOT NULL AND (ny IS NULL OR year - py <= ny - year) THEN py ELSE ny END AS from_year FROM vals""")
def nearest_year_fill(spark: SparkSession, sf: str) -> DataFrame:
    """JON14: the nearest observed year, the past on a tie."""
    return panel.nearest_fill(cells(spark, sf), ["tipo"]).select("entity", "year", "observed", "tipo", "from_year")


@query(f"WITH {OBS} SELECT a.entity, a.year, a.tipo, b.tipo AS adj_tipo FROM obs a LEFT JOIN obs b ON b.entity = a.entity AND b.year = a.year - 1")
def adjacent_year_join(spark: SparkSession, sf: str) -> DataFrame:
    """SRC08: exactly the year before, not the row before."""
    return joins.adjacent(observations(spark, sf).select("entity", "year", "tipo"), -1, ["tipo"])


BRACKETS = [(0.0, 1000.0, 10.0, 0.001), (1000.0, 1300.0, 11.0, 0.002), (1300.0, 1600.0, 11.6, 0.004), (1600.0, None, 12.8, 0.008)]


def _brackets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BRACKETS, "lower double, upper double, fixed double, rate double")


_BRACKET_SQL = "(VALUES (0.0::DOUBLE, 10.0::DOUBLE, 0.001::DOUBLE), (1000.0, 11.0, 0.002), (1300.0, 11.6, 0.004), (1600.0, 12.8, 0.008)) b(lower, fixed, rate)"


@query(f"""
WITH hit AS (SELECT p_partkey, p_retailprice, p_size, b.* FROM part JOIN {_BRACKET_SQL} ON b.lower <= p_retailprice QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY b.lower DESC) = 1)
SELECT p_partkey, lower, round(fixed + greatest(p_retailprice - lower, 0) * rate, 7) AS tax, round(greatest((fixed + greatest(p_retailprice - lower, 0) * rate) * (1 + p_size / 100.0), 12.0), 7) AS charged FROM hit
""")
def bracket_tax(spark: SparkSession, sf: str) -> DataFrame:
    """JON15, NUM05, NUM06: progressive tax by brackets, then surcharge and a minimum."""
    x = joins.bracket_join(table(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size"), _brackets(spark), "p_retailprice")
    tax = F.col("fixed") + F.greatest(F.col("p_retailprice") - F.col("lower"), F.lit(0.0)) * F.col("rate")
    return x.select("p_partkey", "lower", F.round(tax, 7).alias("tax"), F.round(numeric.with_surcharge(tax, F.col("p_size"), F.lit(12.0)), 7).alias("charged"))


@query("""
WITH hit AS (SELECT c_custkey, c_acctbal, c_mktsegment = 'BUILDING' AS built, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE floor(least(c_acctbal, 9999.99) / 2500) * 2500 END AS lower FROM customer)
SELECT c_custkey, built, round((CASE WHEN built THEN 20 ELSE 10 END) + lower / 100 + greatest(c_acctbal - lower, 0) * (CASE WHEN built THEN 0.002 ELSE 0.005 END), 7) AS tax FROM hit
""")
def two_column_bracket_tax(spark: SparkSession, sf: str) -> DataFrame:
    """NUM07, PRJ21: one of two tables by a flag; below the first bound the excess is 0."""
    rows = lambda base, rate: F.array(*[F.struct(F.lit(float(lo)).alias("lower"), F.lit(base + lo / 100).alias("fixed"), F.lit(rate).alias("rate")) for lo in (0, 2500, 5000, 7500)])
    built = F.col("c_mktsegment") == "BUILDING"
    tax = numeric.two_column_tax(F.col("c_acctbal"), built, rows(20.0, 0.002), rows(10.0, 0.005))
    return table(spark, sf, "customer").select("c_custkey", built.alias("built"), F.round(tax, 7).alias("tax"))


@query("""
SELECT doc_id, (length(text) // 2)::BIGINT AS at, greatest(1, len(list_filter(list_transform(range(0, length(text) // 700 + 1), lambda i: i * 700), lambda s: s <= length(text) // 2)))::BIGINT AS page FROM documents
""")
def offset_to_page(spark: SparkSession, sf: str) -> DataFrame:
    """JON16: the page of a character offset."""
    at = F.floor(F.length("text") / 2)
    return table(spark, sf, "documents").select("doc_id", at.alias("at"), joins.page_of(at, F.sequence(F.lit(0), F.length("text"), F.lit(700))).cast("long").alias("page"))


@query("""
WITH a AS (SELECT o_custkey AS entity, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INT AS position FROM orders),
b AS (SELECT user_id AS entity, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)::INT AS position FROM events)
SELECT entity, position, o_orderkey, event_id FROM a JOIN b USING (entity, position)
""")
def positional_zip(spark: SparkSession, sf: str) -> DataFrame:
    """JON17: the i-th of one list with the i-th of another."""
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("entity"), "o_orderkey", "o_orderdate")
    b = table(spark, sf, "events").select(F.col("user_id").alias("entity"), "event_id", "ts")
    return joins.positional_zip(a, b, ["entity"], ["o_orderdate", "o_orderkey"], ["ts", "event_id"]).select("entity", "position", "o_orderkey", "event_id")


@query(f"""WITH {CELLS}, nat AS (SELECT c_custkey AS entity, c_nationkey AS nation FROM customer),
donors AS (SELECT nation, year, entity AS donor, tipo AS donor_tipo FROM (SELECT n.nation, o.*, row_number() OVER (PARTITION BY n.nation, o.year ORDER BY o.entity) AS rn FROM obs o JOIN nat n USING (entity)) WHERE rn = 1)
SELECT c.entity, c.year, d.donor, d.donor_tipo FROM cells c JOIN nat n USING (entity) JOIN donors d ON d.nation = n.nation AND d.year = c.year WHERE NOT c.observed AND d.donor <> c.entity""")
def donor_excluding_self(spark: SparkSession, sf: str) -> DataFrame:
    """JON18, IMP06: a gap takes the first other entity of its group in the year."""
    nat = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_nationkey").alias("nation"))
    d = joins.first_donors(observations(spark, sf).join(nat, "entity"), "nation", ["tipo"])
    d = d.select("nation", "year", F.col("entity").alias("donor"), F.col("tipo").alias("donor_tipo"))
    return cells(spark, sf).filter("NOT observed").join(nat, "entity").join(d, ["nation", "year"]).filter("donor <> entity").select("entity", "year", "donor", "donor_tipo")


def _imputed(spark: SparkSession, sf: str) -> DataFrame:
    return panel.impute(cells(spark, sf), "tipo", ["rangos"])


@query(f"WITH {IMPUTED} SELECT entity, year, tipo, rangos, imputed_from_year FROM imputed WHERE imputed_method = 'confirmed_fill'")
def impute_confirmed(spark: SparkSession, sf: str) -> DataFrame:
    """IMP01: between equal neighbours."""
    return _imputed(spark, sf).filter("imputed_method = 'confirmed_fill'").select("entity", "year", "tipo", "rangos", "imputed_from_year")


@query(f"WITH {IMPUTED} SELECT entity, year, tipo, rangos, imputed_method, imputed_from_year FROM imputed WHERE imputed_method IN ('ffill', 'bfill')")
def impute_ffill_bfill(spark: SparkSession, sf: str) -> DataFrame:
    """IMP02, IMP03."""
    return _imputed(spark, sf).filter("imputed_method IN ('ffill', 'bfill')").select("entity", "year", "tipo", "rangos", "imputed_method", "imputed_from_year")


@query(f"WITH {IMPUTED} SELECT entity, year, tipo, rangos, imputed_from_year FROM imputed WHERE imputed_method = 'closure_fill'")
def impute_closure(spark: SparkSession, sf: str) -> DataFrame:
    """IMP04: between equal ends."""
    return _imputed(spark, sf).filter("imputed_method = 'closure_fill'").select("entity", "year", "tipo", "rangos", "imputed_from_year")


@query(f"WITH {IMPUTED} SELECT entity, year, tipo, rangos FROM imputed WHERE imputed_method = 'tipo_only_fill'")
def impute_tipo_only(spark: SparkSession, sf: str) -> DataFrame:
    """IMP05: kind alone; other values are null."""
    return _imputed(spark, sf).filter("imputed_method = 'tipo_only_fill'").select("entity", "year", "tipo", "rangos")


@query(f"WITH {IMPUTED} SELECT gap_reason, year, count(*)::BIGINT AS n FROM imputed WHERE gap_reason IS NOT NULL GROUP BY 1, 2")
def gap_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """IMP07: what is left, and why."""
    return aggregates.counts(_imputed(spark, sf).filter("gap_reason IS NOT NULL"), "gap_reason", "year")


@query(f"WITH {IMPUTED} SELECT * FROM imputed")
def impute_full_balanced(spark: SparkSession, sf: str) -> DataFrame:
    """IMP01-IMP05, IMP07-IMP09, OTH03: the balanced panel with provenance."""
    return _imputed(spark, sf)


@query(f"""WITH {CELLS}, best AS (SELECT entity, tipo, year AS source_year FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY CASE tipo WHEN 'P' THEN 1 WHEN 'F' THEN 2 END, year DESC) AS rn FROM obs WHERE tipo IN ('P', 'F')) WHERE rn = 1)
SELECT entity, y.year, tipo, source_year FROM best CROSS JOIN (SELECT unnest(range(1995, 2002))::BIGINT AS year) y""")
def impute_canonical_priority(spark: SparkSession, sf: str) -> DataFrame:
    """IMP11, IMP20: the latest year of the best-ranked kind, for all years."""
    return panel.canonical_priority(observations(spark, sf), "tipo", ["P", "F"], YEARS)


@query(f"""WITH {CELLS}, nat AS (SELECT c_custkey AS entity, c_nationkey AS nation FROM customer), seen AS (SELECT c.*, nation FROM cells c JOIN nat USING (entity)),
mine AS (SELECT entity, tipo AS m FROM (SELECT entity, tipo, row_number() OVER (PARTITION BY entity ORDER BY count(*) DESC, tipo) AS rn FROM seen WHERE observed GROUP BY entity, tipo) WHERE rn = 1),
peers AS (SELECT nation, year, tipo AS m FROM (SELECT nation, year, tipo, row_number() OVER (PARTITION BY nation, year ORDER BY count(*) DESC, tipo) AS rn FROM seen WHERE observed GROUP BY nation, year, tipo) WHERE rn = 1)
SELECT s.entity, s.year, nation, CASE WHEN observed THEN s.tipo ELSE coalesce(mine.m, peers.m, 'O') END AS tipo, CASE WHEN observed THEN 'raw' WHEN mine.m IS NOT NULL THEN 'modal_entity' WHEN peers.m IS NOT NULL THEN 'modal_group' ELSE 'default' END AS method
FROM seen s LEFT JOIN mine ON mine.entity = s.entity LEFT JOIN peers USING (nation, year)""")
def impute_modal_cascade(spark: SparkSession, sf: str) -> DataFrame:
    """IMP12, AGG06, AGG28: entity mode, then group mode, then a default."""
    nat = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_nationkey").alias("nation"))
    return panel.modal_cascade(cells(spark, sf).join(nat, "entity"), "tipo", "nation", "O").select("entity", "year", "nation", "tipo", "method")


_ARM = "CASE WHEN tipo = 'P' THEN 'T' ELSE 'C' END"


@query(f"""WITH {CELLS}, w AS (SELECT entity, year, observed, py, ny, CASE WHEN observed THEN {_ARM} END AS arm, CASE WHEN pt = 'P' THEN 'T' WHEN pt IS NOT NULL THEN 'C' END AS pa, CASE WHEN nt = 'P' THEN 'T' WHEN nt IS NOT NULL THEN 'C' END AS na FROM vals),
c AS (SELECT *, min(CASE WHEN arm = 'T' THEN year END) OVER (PARTITION BY entity) AS ft, max(CASE WHEN arm = 'C' THEN year END) OVER (PARTITION BY entity) AS lc FROM w),
k AS (SELECT *, CASE WHEN ft IS NULL AND lc IS NULL THEN 'no_data' WHEN ft IS NULL THEN 'never' WHEN lc IS NULL THEN 'always' WHEN lc < ft THEN 'cohort' ELSE 'reversion' END AS category FROM c)
SELECT entity, year, observed, category, CASE WHEN observed THEN arm WHEN category = 'always' THEN 'T' WHEN category = 'never' THEN 'C' WHEN category = 'cohort' THEN CASE WHEN year >= ft THEN 'T' ELSE 'C' END
  WHEN category = 'reversion' THEN CASE WHEN py IS NOT NULL AND (ny IS NULL OR year - py <= ny - year) THEN pa ELSE na END END AS arm FROM k""")
def impute_category_aware(spark: SparkSession, sf: str) -> DataFrame:
    """IMP13: by what the entity's observed arms say."""
    x = cells(spark, sf).select("entity", "year", "observed", F.when(F.col("tipo") == "P", "T").when(F.col("observed"), "C").alias("arm"))
    return panel.category_fill(x, "arm")


@query(f"WITH {CELLS} SELECT entity, year, observed, CASE WHEN observed THEN tipo ELSE coalesce(pt, nt) END AS tipo, CASE WHEN observed THEN 'raw' WHEN pt IS NOT NULL THEN 'ffill' WHEN nt IS NOT NULL THEN 'bfill' ELSE 'none' END AS method FROM vals")
def impute_forced_grid(spark: SparkSession, sf: str) -> DataFrame:
    """IMP14: the past first, then the future, however far."""
    return panel.forced_grid(cells(spark, sf).drop("rangos"), ["tipo"])


@query("""
WITH d AS (SELECT user_id AS entity, CAST(ts AS DATE) AS d, arg_min(event_type, (ts, event_id)) AS kind FROM events GROUP BY 1, 2),
n AS (SELECT *, lag(kind) OVER w AS p, lead(kind) OVER w AS nx, lag(d) OVER w AS pd FROM d WINDOW w AS (PARTITION BY entity ORDER BY d))
SELECT entity, d AS day, CASE WHEN p = nx AND p <> kind THEN p ELSE kind END AS kind, (p = nx AND p <> kind) IS TRUE AS filled FROM n
""")
def neighbour_equal_fill(spark: SparkSession, sf: str) -> DataFrame:
    """IMP18: a value between two equal neighbours takes theirs."""
    e = table(spark, sf, "events").select(F.col("user_id").alias("entity"), F.to_date("ts").alias("day"), F.col("event_type").alias("kind"), "ts", "event_id")
    d = panel.keep_first(e, ["entity", "day"], [F.col("ts"), F.col("event_id")])
    w = Window.partitionBy("entity").orderBy("day")
    d = d.withColumns({"p": F.lag("kind").over(w), "n": F.lead("kind").over(w)}).withColumn("filled", F.coalesce((F.col("p") == F.col("n")) & (F.col("p") != F.col("kind")), F.lit(False)))
    return d.select("entity", "day", F.when(F.col("filled"), F.col("p")).otherwise(F.col("kind")).alias("kind"), "filled")


@query("""WITH made AS (SELECT c_custkey AS entity, c_nationkey AS nation, 1990 + (c_custkey % 15)::BIGINT AS created FROM customer)
SELECT entity, nation, created, unnest(range(greatest(created, 1995), 2002))::BIGINT AS year FROM made WHERE greatest(created, 1995) <= 2001""")
def never_treated_expansion(spark: SparkSession, sf: str) -> DataFrame:
    """IMP19, AGG17: a row for each year from the year of creation."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_nationkey").alias("nation"), (1990 + F.col("c_custkey") % 15).cast("long").alias("created"))
    return change.never_treated(c, "created", YEARS)


@query(f"""WITH {OBS}, l AS (SELECT *, lag(tipo) OVER w AS pt, lag(monto) OVER w AS pm, lag(rangos) OVER w AS pr FROM obs WINDOW w AS (PARTITION BY entity ORDER BY year))
SELECT entity, year, tipo, rangos, monto, coalesce(CASE WHEN pm > 0 THEN abs(monto - pm) / pm END > 0.001, false) AS rate_changed, coalesce(tipo <> pt, false) AS schema_changed,
  coalesce(rangos <> pr, false) AS count_changed, coalesce(CASE WHEN pm > 0 THEN abs(monto - pm) / pm END > 0.5, false) AS flag_anomaly FROM l""")
def interannual_change_flags(spark: SparkSession, sf: str) -> DataFrame:
    """WIN01, JON11: flags against the row before."""
    return change.change_flags(observations(spark, sf), "tipo", "monto", "rangos")


@query(f"WITH {OBS}, l AS (SELECT *, lag(tipo) OVER (PARTITION BY entity ORDER BY year) AS pt FROM obs) SELECT entity, year, pt AS from_kind, tipo AS to_kind FROM l WHERE pt <> tipo")
def scheme_switches(spark: SparkSession, sf: str) -> DataFrame:
    """WIN02."""
    return change.switches(observations(spark, sf), "tipo")


@query(f"""WITH {OBS}, n AS (SELECT entity, year, count(*)::BIGINT AS c FROM ord GROUP BY 1, 2), l AS (SELECT n.*, tipo, lag(c) OVER w AS pc, lag(tipo) OVER w AS pt FROM n JOIN obs USING (entity, year) WINDOW w AS (PARTITION BY entity ORDER BY year))
SELECT entity, year, coalesce(CASE WHEN c > 0 AND pc > 0 THEN c * 1.0 / pc END > 2 OR CASE WHEN c > 0 AND pc > 0 THEN c * 1.0 / pc END < 0.5, false) AS jump, coalesce(abs(c - pc) > 2 AND tipo = pt, false) AS unstable FROM l WHERE pc IS NOT NULL""")
def row_count_jumps(spark: SparkSession, sf: str) -> DataFrame:
    """WIN03, WIN04."""
    n = order_rows(spark, sf).groupBy("entity", "year").agg(F.count("*").alias("c"))
    return change.count_jumps(n.join(observations(spark, sf).select("entity", "year", "tipo"), ["entity", "year"]), "c", "tipo")


@query(f"""WITH {OBS}, l AS (SELECT *, row_number() OVER w AS i, coalesce(tipo <> lag(tipo) OVER w, false)::INT AS ch FROM obs WINDOW w AS (PARTITION BY entity ORDER BY year)),
c AS (SELECT *, CASE WHEN i > 1 THEN ch END AS c FROM l), s AS (SELECT *, max(CASE WHEN c = 1 THEN i END) OVER (PARTITION BY entity ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_change FROM c)
SELECT entity, year, (i - 1 - coalesce(last_change, 1))::BIGINT AS stable_run FROM s WHERE c = 1""")
def stable_run_length(spark: SparkSession, sf: str) -> DataFrame:
    """WIN05: unchanged transitions right before a change."""
    obs = change.with_previous(observations(spark, sf), ["tipo"])
    return change.stable_runs(obs, F.col("tipo") != F.col("prev_tipo"))


@query(f"WITH {OBS}, l AS (SELECT *, lag(tipo) OVER (PARTITION BY entity ORDER BY year) AS pt FROM obs) SELECT entity, bool_or(coalesce(tipo <> pt, false)) AS changed FROM l GROUP BY entity")
def stable_entities(spark: SparkSession, sf: str) -> DataFrame:
    """AGG30."""
    return aggregates.changed_entities(change.with_previous(observations(spark, sf), ["tipo"]), F.col("tipo") != F.col("prev_tipo"), "entity")


_STATUS = f"{OBS}, st AS (SELECT entity, year, CASE WHEN tipo = 'F' THEN 'T' ELSE 'C' END AS s FROM obs)"


def _status(spark: SparkSession, sf: str) -> DataFrame:
    return observations(spark, sf).select("entity", "year", F.when(F.col("tipo") == "F", "T").otherwise("C").alias("s"))


@query(f"WITH {_STATUS} SELECT entity, year, s, coalesce(lag(s) OVER w = lead(s) OVER w AND lag(s) OVER w <> s, false) AS is_outlier FROM st WINDOW w AS (PARTITION BY entity ORDER BY year)")
def one_step_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """WIN09."""
    return change.outliers(_status(spark, sf), "s")


_PATTERN = """CASE WHEN {c} = 'T' THEN 'siempre_T' WHEN {c} = 'C' THEN 'siempre_C' WHEN {c} = 'CT' THEN 'clean_onset' WHEN {c} = 'TC' THEN 'reversion_simple' WHEN {c} = 'TCT' THEN 'outlier_year_C_in_T'
WHEN {c} = 'CTC' THEN 'outlier_year_T_in_C' WHEN {c} IN ('CTCT', 'TCTC') THEN 'flip_x2[' || {c} || ']' ELSE 'multi_flip[' || {c} || ']' END"""
_COMPACT = "regexp_replace(regexp_replace({0}, 'T+', 'T', 'g'), 'C+', 'C', 'g')"


@query(f"""WITH {_STATUS}, e AS (SELECT entity, string_agg(s, '' ORDER BY year) AS observed FROM st GROUP BY entity),
q AS (SELECT e.entity, string_agg(coalesce(st.s, '·'), '' ORDER BY y.year) AS seq FROM e CROSS JOIN (SELECT unnest(range(1995, 2002))::BIGINT AS year) y LEFT JOIN st ON st.entity = e.entity AND st.year = y.year GROUP BY e.entity)
SELECT entity, seq, observed, {_PATTERN.format(c=_COMPACT.format("observed"))} AS pattern FROM e JOIN q USING (entity)""")
def trajectory_pattern(spark: SparkSession, sf: str) -> DataFrame:
    """WIN10, WIN13."""
    return change.trajectories(_status(spark, sf), "s", YEARS)


@query(f"""WITH {_STATUS}, o AS (SELECT *, coalesce(lag(s) OVER w = lead(s) OVER w AND lag(s) OVER w <> s, false) AS outlier FROM st WINDOW w AS (PARTITION BY entity ORDER BY year)),
c AS (SELECT entity, {_COMPACT.format("string_agg(s, '' ORDER BY year)")} AS c, count(*) FILTER (WHERE s = 'T') AS nt, count(*) AS n, max(year) FILTER (WHERE s = 'T') AS lt FROM o WHERE NOT outlier GROUP BY entity),
r AS (SELECT o.*, CASE WHEN outlier THEN 'outlier_' || s || '_in_' || CASE s WHEN 'T' THEN 'C' ELSE 'T' END WHEN c IN ('T', 'C', 'CT') THEN NULL
  WHEN c = 'TC' THEN CASE WHEN year > lt AND s = 'C' THEN 'reversion_T_to_C' END
  WHEN s = CASE WHEN nt <= n - nt THEN 'T' ELSE 'C' END THEN 'flip_minority_block_' || s || '_in_majority_' || CASE s WHEN 'T' THEN 'C' ELSE 'T' END END AS reason FROM o JOIN c USING (entity))
SELECT entity, year, reason, CASE WHEN reason = 'reversion_T_to_C' THEN 'T' WHEN s = 'T' THEN 'C' ELSE 'T' END AS expected FROM r WHERE reason IS NOT NULL""")
def reversion_tail(spark: SparkSession, sf: str) -> DataFrame:
    """WIN11, EVS09: anomalous years of a trajectory, and what was expected."""
    return change.anomalous_years(_status(spark, sf), "s")


@query(f"""WITH {CELLS}, f AS (SELECT entity, year, CASE WHEN observed THEN tipo ELSE coalesce(pt, nt) END AS tipo FROM vals), a AS (SELECT *, CASE tipo WHEN 'P' THEN 'T' WHEN 'O' THEN 'W' ELSE 'C' END AS arm_raw FROM f),
b AS (SELECT *, min(CASE WHEN arm_raw = 'T' THEN year END) OVER (PARTITION BY entity) AS ft0 FROM a), c AS (SELECT *, CASE WHEN arm_raw <> 'W' THEN arm_raw WHEN ft0 IS NOT NULL AND year >= ft0 THEN 'T' ELSE 'C' END AS arm FROM b),
d AS (SELECT *, count(*) OVER e AS n, count(*) FILTER (WHERE arm = 'T') OVER e AS nt, min(CASE WHEN arm = 'T' THEN year END) OVER e AS first_treated, max(CASE WHEN arm = 'C' THEN year END) OVER e AS lc FROM c WINDOW e AS (PARTITION BY entity))
SELECT entity, year, tipo, arm, arm_raw, (arm = 'T')::BIGINT AS treated, first_treated, year - first_treated AS event_time,
  CASE WHEN nt = n THEN 'always_treated' WHEN nt = 0 THEN 'never_treated' WHEN lc < first_treated THEN 'clean_adoption' ELSE 'reversion' END AS category FROM d""")
def event_study_panel(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ07, WIN12, IMP15, EVS01-EVS03, EVS07: arms, wildcard, first treated year, event time, category."""
    x = panel.forced_grid(cells(spark, sf).drop("rangos"), ["tipo"]).select("entity", "year", "tipo")
    return change.event_study(x.withColumn("arm", F.when(F.col("tipo") == "P", "T").when(F.col("tipo") == "O", "W").otherwise("C")), "arm")


@query(f"""WITH {CELLS}, f AS (SELECT entity, year, CASE WHEN observed THEN tipo ELSE coalesce(pt, nt) END AS tipo FROM vals)
SELECT entity, min(CASE WHEN tipo = 'P' THEN year END) AS cohort, count(*)::BIGINT AS n_years, count(*) FILTER (WHERE tipo = 'P')::BIGINT AS n_treated FROM f GROUP BY entity""")
def one_row_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    """EVS05, EVS06: an entity's cohort and counts."""
    x = panel.forced_grid(cells(spark, sf).drop("rangos"), ["tipo"])
    return x.groupBy("entity").agg(F.min(F.when(F.col("tipo") == "P", F.col("year"))).alias("cohort"), F.count("*").alias("n_years"), F.count_if(F.col("tipo") == "P").alias("n_treated"))


@query("""SELECT event_id, user_id, ts AS start_ts, coalesce(lead(ts) OVER w, TIMESTAMP '2024-02-01') AS end_ts, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def interval_closing_lead(spark: SparkSession, sf: str) -> DataFrame:
    """WIN07, WIN08: an interval ends where the next begins; the last seen value is carried."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf, "events")
    end = F.coalesce(F.lead("ts").over(w), F.lit("2024-02-01").cast("timestamp_ntz"))
    carried = F.last(F.when(F.col("event_type") == "purchase", F.col("event_id")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return e.select("event_id", "user_id", F.col("ts").alias("start_ts"), end.alias("end_ts"), carried.alias("carried"))


@query("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey LIMIT 25 OFFSET 50")
def pagination(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ08, SRT01, SRT02, SRT09: page 3 of an ordered result; the page is the feature."""
    return aggregates.page(table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), [F.col("c_mktsegment"), F.desc("c_acctbal"), F.col("c_custkey")], 3, 25)


@query("SELECT c_custkey, CASE WHEN trim(c_mktsegment) <> '' AND c_acctbal > 0 THEN trim(c_mktsegment) ELSE trim(c_name) END AS label, lpad(c_nationkey::VARCHAR, 2, '0') || lpad((c_custkey % 1000)::VARCHAR, 3, '0') AS code, substr(sha1(c_nationkey || '|' || c_name), 1, 12) AS id FROM customer")
def sha_ids(spark: SparkSession, sf: str) -> DataFrame:
    """HSH01, HSH02, PRJ01, SRC29: identity keys, short ids, the first filled column."""
    c = table(spark, sf, "customer")
    label = text.first_filled(F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")), F.col("c_name"))
    return c.select("c_custkey", label.alias("label"), text.entity_code(F.col("c_nationkey"), F.col("c_custkey") % 1000).alias("code"), text.short_id(F.col("c_nationkey").cast("string"), F.col("c_name")).alias("id"))
