import pytest
from pyspark.sql import functions as F

from panelspark.operators import change, joins, panel

YEARS = (2010, 2025)


def filled(spark, obs, donors=None, since=None, years=YEARS):
    schema = "entity string, year long, tipo string, rangos long" + (", created long" if since else "")
    df = spark.createDataFrame([(*o, since) for o in obs] if since else obs, schema)
    cells = panel.spine(df, years, since="created" if since else None)
    if donors is not None:
        cells = cells.withColumn("state", F.lit("s"))
    return {(r.entity, r.year): r for r in panel.impute(cells, "tipo", ["rangos"], donors=donors, group="state" if donors is not None else None).collect()}


def methods(rows, entity="e"):
    return {y: r.imputed_method for (e, y), r in rows.items() if e == entity}


def test_confirmed_fill(spark):
    m = methods(filled(spark, [("e", 2010, "a", 1), ("e", 2015, "a", 1)]))
    assert [m[y] for y in range(2010, 2016)] == ["", *["confirmed_fill"] * 4, ""] and m[2016] == "ffill" and m[2019] == "ffill" and m[2020] is None


def test_gap_of_five_is_forward_then_closure(spark):
    m = methods(filled(spark, [("e", 2010, "a", 1), ("e", 2016, "a", 1)]))
    assert [m[y] for y in range(2011, 2016)] == [*["ffill"] * 4, "closure_fill"]


def test_unequal_neighbours_in_a_short_gap_stay_open(spark):
    rows = filled(spark, [("e", 2010, "a", 1), ("e", 2012, "b", 1), ("e", 2014, "b", 2)])
    m = methods(rows)
    assert m[2011] is None and rows["e", 2011].gap_reason == "schema_discontinuity"
    assert m[2013] == "tipo_only_fill" and rows["e", 2013].rangos is None and rows["e", 2013].tipo == "b" and rows["e", 2013].imputed_from_year == 2012


def test_backward_and_reasons(spark):
    rows = filled(spark, [("e", 2018, "a", 1)])
    m = methods(rows)
    assert [m[y] for y in range(2014, 2018)] == ["bfill"] * 4 and m[2013] is None and rows["e", 2013].gap_reason == "long_gap" and rows["e", 2014].imputed_from_year == 2018


def test_blank_kind_is_never_equal(spark):
    assert methods(filled(spark, [("e", 2010, "", 1), ("e", 2012, "", 1)]))[2011] is None


def test_creation_year_and_window(spark):
    m = methods(filled(spark, [("e", 2016, "a", 1)], since=2015))
    assert min(m) == 2015 and m[2015] == "bfill"
    assert methods(filled(spark, [("e", 2009, "a", 1), ("e", 2030, "b", 1), ("e", 2012, "c", 1)]))[2012] == ""


def test_donor_is_another_entity(spark):
    donors = spark.createDataFrame([("s", 2025, "d", "z", 9), ("s", 2024, "e", "z", 9)], "state string, year long, entity string, tipo string, rangos long")
    rows = filled(spark, [("e", 2010, "a", 1)], donors=donors)
    assert rows["e", 2025].imputed_method == "uniform_state_fill" and rows["e", 2025].tipo == "z" and rows["e", 2024].imputed_method is None


def test_no_observation_in_the_window(spark):
    rows = filled(spark, [("e", 2030, "a", 1)])
    assert len(rows) == 16 and {r.gap_reason for r in rows.values()} == {"no_data"}


def test_observed_cells_are_never_altered_and_keys_are_unique(spark):
    import random

    rng = random.Random(1)
    obs = [(f"e{i}", y, rng.choice("abc"), rng.randrange(2)) for i in range(40) for y in range(2010, 2026) if rng.random() < 0.4]
    rows = filled(spark, obs)
    assert len(rows) == len({o[0] for o in obs}) * 16
    for e, y, t, r in obs:
        assert (rows[e, y].tipo, rows[e, y].rangos, rows[e, y].imputed_method) == (t, r, "")
    for r in rows.values():
        assert (r.tipo is None) == (r.imputed_method is None)


def test_keep_first_and_union_by_priority(spark):
    a = spark.createDataFrame([(1, 5, "a5"), (1, 3, "a3")], "k int, o int, v string")
    b = spark.createDataFrame([(1, 0, "b0"), (2, 0, "b0")], "k int, o int, v string")
    assert {r.k: r.v for r in panel.union_by_priority(a, b, keys=["k"], order=["o"]).collect()} == {1: "a3", 2: "b0"}


@pytest.mark.parametrize("y,want", [(2011, 2010), (2012, 2010), (2013, 2014)])
def test_nearest_takes_the_past_on_a_tie(spark, y, want):
    df = spark.createDataFrame([("e", 2010, "a", 1), ("e", 2014, "b", 1)], "entity string, year long, tipo string, rangos long")
    got = {r.year: r.from_year for r in panel.nearest_fill(panel.spine(df, (2010, 2014)), ["tipo"]).collect()}
    assert got[y] == want


def test_event_study_wildcards(spark):
    rows = [("e", y, a) for y, a in enumerate("WCWTWC")] + [("n", y, "W") for y in range(3)] + [("a", y, "T") for y in range(3)]
    got = {(r.entity, r.year): r for r in change.event_study(spark.createDataFrame(rows, "entity string, year long, arm string"), "arm").collect()}
    assert "".join(got["e", y].arm for y in range(6)) == "CCCTTC" and got["e", 4].event_time == 1 and got["e", 0].category == "reversion"
    assert got["n", 0].category == "never_treated" and got["n", 0].event_time is None and got["a", 0].category == "always_treated"


def test_anomalous_years(spark):
    seqs = {"one": "CCTCC", "back": "TTTCC", "flip": "TTCCTT", "clean": "CCTT"}
    df = spark.createDataFrame([(e, y, s) for e, q in seqs.items() for y, s in enumerate(q)], "entity string, year long, s string")
    got = {(r.entity, r.year): r.reason for r in change.anomalous_years(df, "s").collect()}
    assert got == {("one", 2): "outlier_T_in_C", ("back", 3): "reversion_T_to_C", ("back", 4): "reversion_T_to_C", ("flip", 2): "flip_minority_block_C_in_majority_T", ("flip", 3): "flip_minority_block_C_in_majority_T"}


def test_queue_merge(spark):
    new = spark.createDataFrame([("1", "", "n1"), ("2", "", "n2")], "id string, decision string, v string")
    old = spark.createDataFrame([("1", "ok", "o1"), ("2", "", "o2"), ("3", "ok", "o3"), ("4", "", "o4")], "id string, decision string, v string")
    assert {r.id: r.v for r in joins.merge_queues(new, old, "id", "decision").collect()} == {"1": "o1", "2": "n2", "3": "o3"}


def test_spine_shuffles_once(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("entity"), (F.col("id") % 16 + 2010).alias("year"), F.lit("a").alias("tipo"), F.lit(1).alias("rangos"))
    plan = panel.impute(panel.spine(df, YEARS), "tipo", ["rangos"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
