import duckdb
from pyspark.sql import functions as F

from panelspark.operators import coverage
from panelspark.plans import coverage_queries, document_queries


def test_placeholders_and_hints(spark):
    entities = spark.createDataFrame([("a",), ("b",), ("b",)], "entity string")
    docs = spark.createDataFrame([("a", 2000, True, "x"), ("a", 2001, False, "sin_ley"), ("b", 2001, False, "y" * 200), ("b", 2002, None, None)], "entity string, year int, has_table boolean, reason string")
    hints = spark.createDataFrame([("a", 2002, "  XICRÚ \n x", 0.561, "s.pdf"), ("a", 2002, "other", 0.9, None), ("b", 2000, "b", 0.7, "t"), ("b", 2000, "a", 0.7, "u"), ("b", 2001, "filled cell", 1.0, "v"), ("c", 2000, "no such entity", 1.0, "w")], "entity string, year int, raw string, score double, source string")
    empty = coverage.empty_cells(entities, (2000, 2002), docs, hints)
    assert {(r.entity, r.year): r.hint and tuple(r.hint) for r in empty.collect()} == {("a", 2002): ("other", 0.9, None), ("b", 2000): ("a", 0.7, "u")}
    assert {(r.entity, r.year): r.hint for r in coverage.empty_cells(entities, (2000, 2002), docs).collect()} == {("a", 2002): None, ("b", 2000): None}
    rows = {(r.entity, r.year): (r.detector, r.severity, r.signal) for r in coverage.coverage_queue(empty, docs).collect()}
    assert set(rows) == {("a", 2002), ("b", 2000), ("b", 2001), ("b", 2002)}
    assert rows["a", 2002][:2] == ("cobertura_incompleta", "SEV2") and "«other» (score 0.9; )" in rows["a", 2002][2]
    assert rows["b", 2001][1] == "SEV1" and "y" * 120 + ". " in rows["b", 2001][2] and "null): ?." in rows["b", 2002][2]


def test_scores_of_hints_are_rounded_as_the_sql_does(spark):
    scores = [1.015, 0.285, 1.005, 2.675, 0.125, 7.0, None, 1e300, 1e307, -0.001, -0.125]
    entities = spark.createDataFrame([(i,) for i in range(len(scores))], "entity long")
    hints = spark.createDataFrame([(i, 2000, "x", s, "t") for i, s in enumerate(scores)], "entity long, year int, raw string, score double, source string")
    got = {r.entity: r.hint.score for r in coverage.empty_cells(entities, (2000, 2000), hints.select("entity", "year").limit(0), hints).collect()}
    con = duckdb.connect()
    assert {i: repr(s) for i, s in got.items()} == {i: repr(con.execute("SELECT round(?::DOUBLE, 2)", [s]).fetchone()[0]) for i, s in enumerate(scores)} and got[0] == 1.01


def test_hints_of_unplaced_names_against_the_names_themselves(spark, sf):
    got = coverage_queries.QUERIES["coverage_hints"](spark, sf).collect()
    names, catalog, _ = document_queries._raw_names(spark, sf)
    known = {r.key for r in catalog.collect()}
    assert all(r.entity in known and r.year != r.entity % 4 for r in got) and len(got) == len({(r.entity, r.year) for r in got})
    raw = {(r.name, r.year) for r in names.collect()}
    hinted = [r for r in got if r.raw is not None]
    assert hinted and all((r.raw, r.year) in raw and 0.55 <= r.score <= 1 for r in hinted)
    assert len(hinted) < len(got)


def test_verification_is_inside_the_panel_and_once(spark):
    decided = spark.createDataFrame([(1, 2001, "propagar_previo"), (1, 2003, "corregir_previo"), (1, 2000, "corregir_previo"), (2, 2001, "propagar_previo"), (3, 2004, "propagar_previo"), (4, 2001, "propagar_previo")], "entity long, year int, decision string")
    docs = spark.createDataFrame([(e, y) for e in (1, 2, 3) for y in range(2000, 2006)], "entity long, year int")
    queue = spark.createDataFrame([(2, 2002, "old")], "entity long, year int, id string")
    step = F.when(F.col("decision") == "propagar_previo", 1).otherwise(-1)
    got = {(r.entity, r.year): (r.id, r.reused, r.signal) for r in coverage.verification_rows(decided, docs, queue, (2000, 2005), step, F.lit("x")).collect()}
    assert set(got) == {(1, 2002), (2, 2002)} and got[2, 2002][:2] == ("old", True) and not got[1, 2002][1] and "en 2001" in got[1, 2002][2] and "2001→2002" in got[1, 2002][2]


def test_every_declared_rule_fires(spark, sf):
    found = {r.detector for r in coverage_queries.QUERIES["declared_detectors"](spark, sf).select("detector").distinct().collect()}
    assert found == {"tabla_vacia", "otro_no_clasificado", "progresivo_tasa_cero", "rangos_no_monotonos", "tarifa_millar_factor"}
    signals = {r.signal for r in coverage_queries.QUERIES["unverified_boundaries"](spark, sf).select("signal").distinct().collect()}
    assert len(signals) >= 2
    assert coverage_queries.QUERIES["short_gap_changes"](spark, sf).filter("same_kind").count() > 0
