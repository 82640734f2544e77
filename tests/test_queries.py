import duckdb
import pytest

from panelspark.operators import joins, segment
from panelspark.plans import registry
from tests.sqlcheck import same_rows


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_matches_sql(spark, sf, name):
    same_rows(spark, sf, registry.queries()[name], registry.oracle_sql()[name])


def test_flagship(spark, sf):
    df = registry.flagship(spark, sf)
    assert df.count() > 0 and {"imputed_method", "event_time", "n_name"} <= set(df.columns)


def test_entry_point(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0


def test_accepted_hits_are_a_fold(spark, sf):
    got = {r.user_id: r.accepted for r in registry.queries()["accepted_hits_apart"](spark, sf).collect()}
    want = {}
    rows = {}
    for r in spark.read.parquet(f"{sf}/events.parquet").collect():
        rows.setdefault(r.user_id, []).append(r.event_id)
    for u, ids in rows.items():
        last, n = None, 0
        for i in sorted(ids):
            if last is None or i - last > 25:
                last, n = i, n + 1
        want[u] = n
    assert got == want


def test_fuzzy_cascade_stages(spark, sf):
    got = registry.queries()["fuzzy_cascade"](spark, sf).collect()
    assert {r.stage for r in got} - {"exact", "alias", "suffix", "words", "ratio", "none"} == set()
    assert all((r.key == "") == (r.score < 0.85) for r in got)


def test_texts_are_read_whole(spark, tmp_path):
    rows = [(1, "Á" * 300 + " Fin, uno, dos y tres"), (2, "NiÃ±o"), (3, "a�b�"), (4, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    run = lambda name: {r.doc_id: r for r in registry.queries()[name](spark, str(tmp_path)).collect()}
    whole = run("normalize_whole_text")[1]
    assert whole.norm_light == "a" * 300 + " fin, uno, dos y tres" and whole.norm == whole.norm_light.upper()
    assert {k: r.names for k, r in run("listed_names").items()} == {1: 4, 2: 1, 3: 1, 4: 0}
    assert {k: r.quality for k, r in run("text_scores").items() if k > 1} == {2: 4, 3: 2 - 3 * 2, 4: 0}


def test_pages_of_very_long_texts(spark, tmp_path):
    rows = [(n, "x" * n) for n in (0, 1399, 1400, 56000, 128657)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.page for r in registry.queries()["offset_to_page"](spark, str(tmp_path)).collect()}
    assert got == {n: n // 2 // 700 + 1 for n, _ in rows}


@pytest.mark.parametrize("name", ["flattened_records_deduped", "rescue_predicate"])
def test_groups_are_not_gathered_in_a_row(spark, sf, name):
    assert "collect_list" not in registry.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()


def test_names_against_brute_force(spark, sf):
    """Every name by the stages one after another, against every catalog name of its block."""
    from difflib import SequenceMatcher

    from panelspark.operators import identity
    from panelspark.plans.document_queries import _raw_names

    names, catalog, aliases = (x.collect() for x in _raw_names(spark, sf))
    cat, alias = {}, {(r.block, r.name): r.key for r in aliases}
    for r in catalog:
        cat.setdefault(r.block, {})
        cat[r.block][r.name] = min(r.key, cat[r.block].get(r.name, r.key))

    def match(block, name, least):
        c = cat[block]
        if name in c:
            return c[name], 1.0, "exact"
        if (block, name) in alias:
            return alias[block, name], 1.0, "alias"
        for x in identity.SUFFIXES:
            if name.endswith(x) and name[: -len(x)] in c:
                return c[name[: -len(x)]], 0.95, "suffix"
        w = set(name.split("_"))
        ratio = lambda s: (-SequenceMatcher(None, name, s).ratio(), s)
        for stage, near, floor in (("words", [s for s in c if w <= set(s.split("_")) or set(s.split("_")) <= w], 0.5), ("ratio", list(c), least)):
            score, slug = min(map(ratio, near), default=(0, None))
            if -score >= floor:
                return c[slug], -score, stage
        return None, 0.0, "none"

    got = {(r.block, r.name): (r.key, r.score, r.stage) for r in registry.queries()["fuzzy_cascade"](spark, sf).collect()}
    want = {}
    for r in names:
        key, score, stage = match(r.block, r.name, 0.85)
        want[r.block, r.name] = (str(key) if score >= 0.85 else "", score, stage)
    assert got == want and {x[2] for x in got.values()} == {"exact", "alias", "suffix", "words", "ratio", "none"}
    best = {}
    for r in names:
        key, score, _ = match(r.block, r.name, 0.55)
        if key is not None and score >= 0.55:
            best[r.block, key, r.year] = max(best.get((r.block, key, r.year), (0, "")), (score, r.name))
    hints = {(r.block, r.key, r.year): (r.score, r.name) for r in registry.queries()["name_hints"](spark, sf).collect()}
    assert hints == best


def test_pairs_that_may_be_alike_miss_none_and_are_few(spark):
    import random
    from difflib import SequenceMatcher

    from panelspark.operators import identity

    rng = random.Random(7)
    syllables = [c + v for c in "bcdfglmnprst" for v in "aeiou"]
    counts = {}
    for n in (300, 1200):
        base = [("_" if rng.random() < 0.1 else "").join(rng.choice(syllables) for _ in range(rng.randrange(1, 8))) for _ in range(n)]

        def typo(x):
            for _ in range(rng.choice([0, 1, 1, 2])):
                i = rng.randrange(len(x) + 1)
                x = rng.choice([x[:i] + x[i + 1 :], x[:i] + rng.choice("aeiouxyz") + x[i:], x[:i] + rng.choice("aeiouxyz") + x[i + 1 :]])
            return x or "a"

        names, cat = sorted({typo(x) for x in base}), sorted(set(base) | {"a", "ab", "abc"})
        df = lambda rows, c: spark.createDataFrame([("s", x) for x in rows], f"block string, {c} string")
        pairs = {(r.name, r.slug) for r in identity.alike_pairs(df(names, "name"), df(cat, "slug"), "block", "name", "slug", 0.85).collect()}
        if n == 300:
            for least in (0.55, 0.7, 0.85, 0.95):
                some = {(r.name, r.slug) for r in identity.alike_pairs(df(names, "name"), df(cat, "slug"), "block", "name", "slug", least).collect()}
                assert {(x, y) for x in names for y in cat if SequenceMatcher(None, x, y).ratio() >= least} <= some
        counts[n] = len(pairs)
    assert counts[300] < 300 * 8 and counts[1200] < 1200 * 8  # of 90,000 and 1,440,000


def test_hits_at_large_positions(spark):
    from pyspark.sql import functions as F

    from panelspark.operators import segment

    p = F.array(*[F.lit(2**31 + x).cast("long") for x in (0, 10, 26, 60)])
    got = spark.range(1).select(segment.accepted_apart(p, 25).alias("a"), segment.accepted_count(p, 25).alias("n")).first()
    assert [x - 2**31 for x in got.a] == [0, 26, 60] and got.n == 3


def test_every_scheme_detector_fires(spark, sf):
    from panelspark.operators import documents

    fired = {r.detector for r in registry.queries()["scheme_detectors"](spark, sf).select("detector").distinct().collect()}
    assert fired == {d.name for d in documents.scheme_detectors()}


def test_every_variant_and_every_fault_occurs(spark):
    from panelspark.operators import variants
    from panelspark.plans.variant_queries import second_form_documents

    rows = second_form_documents(spark, "/root/testdata/sf0.01").select("scheme", "faults", "category").distinct().collect()
    assert {r.scheme for r in rows} == {*variants.VARIANTS, variants.OTHER}
    faults = {part.split(": ")[1] for r in rows if r.faults for part in r.faults.split("; ")}
    assert faults == {"few_rows", "not_one_row", "no_value", "unit", "no_rate", "no_comment", "descending", "brackets"}
    assert {r.category for r in rows} == {None, "estructura_no_estandar", "segmento_vacio"}


def test_second_form_of_empty_documents(spark):
    from panelspark.operators import variants

    bracket = "array<struct<n:string,lower:string,upper:string,fixed:string,rate:string>>"
    schema = f"declared string, comment string, millar array<struct<label:string,rate:string>>, progresiva {bracket}, unica array<struct<label:string,rate:string,unit:string>>, fija array<struct<label:string,amount:string>>, mixta array<struct<n:string,lower:string,upper:string,columns:map<string,string>>>"
    docs = [(None, None, None, None, None, None, None), ("mixto", "x", [], [], [], [], []), ("progresivo", None, [], [("I-1", "$0.00", "1,000", "$5", "0"), ("I-2", "1,000.01", "En adelante", None, "2.5")], [], [], [])]
    got = variants.second_form(spark.createDataFrame(docs, schema)).collect()
    assert [(r.scheme, r.category) for r in got] == [("otro_no_clasificado", "segmento_vacio")] * 2 + [("progresivo", None)]
    assert [(r.n, r.lower, r.upper, r.fixed, r.rate) for r in got[2]["rows"]] == [(1, 0.0, 1000.0, 5.0, 0.0), (2, 1000.0, None, 0.0, 2.5)]


def test_entities_against_brute_force(spark, sf):
    import re

    from panelspark.plans.variant_queries import ENTITIES, RULED_OUT

    got = {(r.doc_id, r.entity.lower()): (r.entity, r.pattern, r.ordinal) for r in registry.queries()["entities_by_patterns"](spark, sf).collect()}
    want = {}
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        for name, pattern in ENTITIES:
            at, n, rule = 0, 0, re.compile(pattern, re.MULTILINE | re.ASCII)
            while m := rule.search(d.text or "", at):
                if any(w in d.text[max(0, m.start() - 40) : m.start()] for w in RULED_OUT):
                    at = m.start() + 1
                    continue
                want.setdefault((d.doc_id, m[1].lower()), (m[1], name, n))
                at, n = m.end(), n + 1
    assert got == want


def test_names_in_texts_whole(spark, sf, tmp_path):
    # the third words of types in all types of the brand; the empty name is in every text, null in none, repeated rows count
    types = ["A", "A TIN", "A B TIN", "TINY A IN", "A B ", "X Y A", "IN TIN B A", "", None]
    rows = [(i % 90, None if i % 13 == 0 else f"b{i % 2}", types[i % 9], 40 + i % 11) for i in range(120)]
    spark.createDataFrame([(*r, "small ring") for r in rows], "p_partkey long, p_brand string, p_type string, p_size int, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    word = lambda t: None if t is None else (t.split(" ") + ["", ""])[2]
    pairs = lambda rows: sorted((k, o) for k, b, t, _ in rows for o, c, u, n in rows if n > 45 and b and b == c and None not in (t, u) and word(t) in u)
    run = lambda path: sorted(map(tuple, registry.queries()["contained_names"](spark, str(path)).collect()))
    assert run(tmp_path) == pairs(rows)
    assert {word(t) for _, _, t, _ in rows} >= {"", "TIN", "IN", "A"}
    driver = [tuple(r) for r in spark.read.parquet(f"{sf}/part.parquet").select("p_partkey", "p_brand", "p_type", "p_size").collect()]
    assert run(sf) == pairs(driver) and pairs(driver)


def test_products_are_dealt_in_cells(spark, monkeypatch):
    monkeypatch.setattr(joins, "CELL", 3)
    monkeypatch.setattr(joins, "TASK_PAIRS", 50)
    left = [(k, i) for k, n in (("a", 20), ("b", 1), ("c", 7), (None, 4), ("d", 2)) for i in [*range(n), 0]]
    right = [(k, i) for k, n in (("a", 5), ("b", 30), ("c", 1), (None, 4), ("e", 9)) for i in [*range(n), 0]]
    out = joins.product_join(spark.createDataFrame(left, "k string, x long"), spark.createDataFrame(right, "k string, y long"), ["k"])
    assert out.columns == ["k", "x", "y"]
    assert sorted(map(tuple, out.collect())) == sorted((k, x, y) for k, x in left for c, y in right if k and k == c)
    none = joins.product_join(spark.createDataFrame([], "k string, x long"), spark.createDataFrame(right, "k string, y long"), ["k"])
    assert none.count() == 0


SECTIONS = [("ab. cd" + "e" * 30 + "\n", 1), ("😀 ab. 😀" + "e" * 30 + "\n end", 2), ("x. " + "y" * 2500 + "\na", 3), ("no end. " + "z" * 2500, 4), ("Der. Und. Für.\nZu engen tag\n", 5), (". a", 6), ("none", 7), (None, 8), ("b. " + "c" * 600 + "a\n", 9)]


@pytest.mark.parametrize("name", ["section_locator", "section_locator_hooks"])
def test_sections_of_odd_texts_are_those_of_the_sql(spark, tmp_path, name):
    spark.createDataFrame(SECTIONS, "text string, doc_id long").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(map(tuple, registry.queries()[name](spark, str(tmp_path)).select(*columns).collect())) == sorted(found.fetchall())


def test_entities_look_behind_only_where_a_pattern_holds(spark):
    from pyspark.sql import functions as F

    text = "and so by the of which they with of one; THE two of three. " * 10
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    pattern = r"\b(?:of|de|the)\s+([a-z]+)"
    got = segment.entities(df, "doc_id", "text", [("plain", pattern)], ["by the", "with"], 40)
    assert "(?m)(?=" + pattern + ")(?<!" in got._jdf.queryExecution().optimizedPlan().toString()
    # the form without looking ahead
    plain = F.regexp_extract_all("text", F.lit(r"(?m)(?<!by\ the[\s\S]{0,34}|with[\s\S]{0,36})(?:" + pattern + ")"), F.lit(1))
    assert {r.entity for r in got.collect()} == set(df.select(plain.alias("x")).first().x)
