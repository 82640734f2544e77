import shutil
import json

from pyspark.sql import functions as F

from panelspark.operators import documents, identity, review, segment
from panelspark.sources import files
from panelspark.streaming import decisions


def test_csv_round_trip(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_bytes(b"\xef\xbb\xbfa,b\n1,x\n2,\xff\n")
    df = files.read_csv(spark, str(p))
    assert df.columns == ["a", "b"] and [r.b for r in df.collect()][1] == "�"
    files.write_csv(df.withColumn("c", F.lit(None)), str(tmp_path / "out"), ["b", "a", "missing"])
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).columns == ["b", "a", "missing"]
    (tmp_path / "t.tsv").write_text("a\tb,c\td\n")
    assert files.delimiter_of(spark, str(tmp_path / "t.tsv")) == "\t"


def test_documents_by_file(spark, tmp_path):
    d = tmp_path / "x" / "2020"
    d.mkdir(parents=True)
    (d / "AGS_PREDIAL_2020_san_jose.json").write_text(json.dumps({"scheme": "a"}))
    (d / "AGS_PREDIAL_2021_other.json").write_text("{broken")
    rows = files.read_documents(spark, str(tmp_path / "x"), "scheme string").withColumn("p", files.name_parts(F.col("file_name"))).cache().collect()
    by = {r.p.year: r for r in rows}
    assert by[2020].scheme == "a" and by[2020].p.slug == "san_jose" and by[2021].scheme is None and by[2021]._corrupt


def test_overlay_layout_and_absent(spark, tmp_path):
    a, b = spark.createDataFrame([("k1", 1)], "k string, v int"), spark.createDataFrame([("k1", 0), ("k2", 0)], "k string, v int")
    assert {r.k: r.v for r in files.overlay(a, b, "k").collect()} == {"k1": 1, "k2": 0}
    got = files.by_layout(spark.createDataFrame([(1, "s")], "ejercicio int, slug string"), {"x": {"year": "anio"}, "y": {"year": "ejercicio", "name": "slug"}}).first()
    assert (got.year, got.name) == ("1", "s")
    for _ in range(2):
        files.write_if_absent(b, str(tmp_path / "t"), ["k"], ["k"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    files.quarantine(b, F.col("k") == "k2", str(tmp_path / "good"), str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1


def test_response_routes(spark):
    lines = ['{"custom_id":"ags|x|2020","response":{"status_code":200,"body":"b"}}', '{"custom_id":"bad"}', '{"custom_id":"a|b|1","error":"e"}', '{"custom_id":"a|b|1","response":{"status_code":500}}', "no json"]
    got = [r.route for r in files.response_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()]
    assert got == ["ok", "bad_id", "error", "status", "bad_json"]


def test_queue_and_decisions(spark):
    rows = [("c1", "d1", "SEV2", "s1"), ("c1", "d2", "SEV1-H", "s2"), ("c2", "d1", "SEV3", "s3")]
    q = {r.cell: r for r in review.consolidate(spark.createDataFrame(rows, "cell string, detector string, severity string, signal string"), ["cell"]).collect()}
    assert q["c1"].severity == "SEV1-H" and q["c1"].detectors == "d2|d1" and len(q["c1"].id) == 12
    log = spark.createDataFrame([("1", "2020", 1, "a"), ("1", "2021", 2, "b"), ("1", "2021", 3, "c")], "id string, t string, n int, decision string")
    assert review.latest_decisions(log, "id", "t", "n").first().decision == "c"
    queue = spark.createDataFrame([(1, "x"), (2, ""), (3, "")], "p int, d string")
    assert [review.next_pending(queue, "p", a, "d").first().p for a in (0, 2, 3)] == [2, 3, 2]


def test_detectors(spark):
    schema = "k string, scheme string, rows array<struct<lower:double,upper:double,fixed:double,rate:double>>"
    docs = spark.createDataFrame([
        ("ok", "progresivo", [(0.0, 10.0, 1.0, 0.1), (10.0, None, 2.0, 0.2)]), ("empty", "progresivo", []), ("zero", "progresivo", [(0.0, None, 1.0, 0.0)]),
        ("closed", "progresivo", [(0.0, 10.0, 1.0, 0.1)]), ("drop", "progresivo", [(0.0, 10.0, 5.0, 0.1), (10.0, None, 2.0, 0.2)]), ("factor", "tarifa_millar", [(None, None, None, 0.002), (None, None, None, 0.0)]), ("other", "otro_no_clasificado", None),
    ], schema)
    got = {}
    for r in documents.detect(docs, ["k"], documents.table_detectors()).collect():
        got.setdefault(r.k, set()).add(r.detector)
    assert got == {"empty": {"tabla_vacia"}, "zero": {"progresivo_tasa_cero"}, "closed": {"bracket_superior_cerrado"}, "drop": {"rangos_no_monotonos"}, "factor": {"tarifa_millar_factor"}, "other": {"otro_no_clasificado"}}


def test_name_stages(spark):
    cat = spark.createDataFrame([("s", "saltillo", 1), ("s", "valle_de_bravo", 2), ("s", "guadalajara", 3)], "block string, name string, key long")
    alias = spark.createDataFrame([("s", "gdl", 3)], "block string, name string, key long")
    names = spark.createDataFrame([("s", n) for n in ("saltillo", "gdl", "valle_bravo", "guadalajra", "guadalajara_jalisco", "zzz", "saltillo")], "block string, name string")
    got = {r.name: (r.key, r.stage) for r in identity.match_names(names, cat, "block", "name", "key", alias).collect()}
    assert got == {"saltillo": (1, "exact"), "gdl": (3, "alias"), "valle_bravo": (2, "words"), "guadalajra": (3, "ratio"), "guadalajara_jalisco": (3, "words"), "zzz": (None, "none")}


def test_section_and_packing(spark):
    p = segment.SectionPatterns(starts=[("strict", "IMPUESTO PREDIAL", 0.9), ("loose", "PREDIAL", 0.6)], ends=["CAPITULO"], blacklist="INDICE", least=10, most=60)
    rows = [("x IMPUESTO PREDIAL se causa y paga asi CAPITULO II",), ("INDICE IMPUESTO PREDIAL",), ("PREDIAL sin final",), ("nada",), (None,)]
    got = [r.s for r in spark.createDataFrame(rows, "t string").select(segment.locate(F.col("t"), p).alias("s")).collect()]
    assert [s.method for s in got] == ["strict", "none", "loose", "none", "none"] and rows[0][0][got[0].start : got[0].end].startswith("IMPUESTO PREDIAL se causa") and got[2].confidence == 0.48
    sizes = spark.createDataFrame([("g", i, s) for i, s in enumerate([5, 5, 5, 20, 1, 1, 1])], "g string, i int, s long")
    assert [r.batch for r in sorted(segment.packed(sizes, "g", "i", "s", 10, 2).collect(), key=lambda r: r.i)] == [0, 0, 1, 2, 3, 3, 4]


def test_decision_stream(spark, tmp_path):
    log, target, checkpoint = (str(tmp_path / x) for x in ("log", "out", "cp"))
    schema = "id string, t string, n int, decision string"
    assert decisions.current(spark, target, schema).count() == 0

    def take(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(log)
        decisions.keep_latest(decisions.read_log(spark, log, schema), target, checkpoint, "id", "t", "n", parts=8).awaitTermination()
        return {r.id: r.decision for r in decisions.current(spark, target, schema).collect()}

    assert take([(None, "2030", 0, "x"), ("", "2030", 0, "x")]) == {}
    many = [(str(i), "2020", i, "a") for i in range(40)]
    assert take(many) == {str(i): "a" for i in range(40)}
    # later, earlier than what is known, a tie of time, twice in a batch
    assert take([("1", "2021", 3, "c"), ("2", "2019", 99, "late"), ("3", "2020", 50, "tie"), ("4", "2021", 1, "p"), ("4", "2021", 2, "q")]) == {str(i): "a" for i in range(40)} | {"1": "c", "3": "tie", "4": "q"}
    before = {p.name for p in (tmp_path / "out/rows").iterdir()}
    assert take([("7", "2022", 0, "z")])["7"] == "z"
    (number,) = {p.name for p in (tmp_path / "out/rows").iterdir()} - before
    assert len([p for p in (tmp_path / "out/rows" / number).iterdir() if p.name.startswith("part=")]) == 1
    # a batch whose note is missing doesn't count, and is made again alike
    known = {r.id: r.decision for r in decisions.current(spark, target, schema).collect()}
    shutil.rmtree(tmp_path / "out/notes" / number)
    assert {r.id: r.decision for r in decisions.current(spark, target, schema).collect()} == known | {"7": "a"}
    (tmp_path / "cp/commits" / number).unlink()
    (tmp_path / f"cp/commits/.{number}.crc").unlink(missing_ok=True)
    assert take([("8", "2022", 0, "y")]) == known | {"8": "y"}
    stream = decisions.latest_stream(decisions.read_log(spark, log, schema), "id", "t", "n")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("latest_decisions").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.id: r.decision for r in spark.table("latest_decisions").collect()} == known | {"8": "y"}


def test_reports(spark):
    df = spark.createDataFrame([("a_b", 1), (None, 2)], "k string, n int")
    assert files.markdown_table(df) == "| k | n |\n|---|---|\n| a_b | 1 |\n|  | 2 |"
    assert "a\\_b & 1 \\\\" in files.latex_table(df)


def test_steps(spark):
    import pytest

    from panelspark.plans import steps

    steps.step("plus")(lambda df: df.withColumn("id", F.col("id") + 1))
    assert [r.id for r in steps.run_steps(spark.range(2), ["plus", "plus"]).collect()] == [2, 3]
    with pytest.raises(ValueError):
        steps.run_steps(spark.range(2), ["plus", "none"])
    with pytest.raises(ValueError):
        steps.step("plus")(lambda df: df)


def test_deep_values(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": 25, "c": "x"}, "d": [1, 30]}'), (2, "broken")], "k int, j string")
    assert {(r.k, r.path, r.value) for r in documents.deep_values(df, ["k"], "j").collect()} >= {(1, "a.b", "25"), (1, "a.c", "x"), (1, "d.0", "1"), (1, "d.1", "30")}


def test_section_after_refused_matches(spark):
    p = segment.SectionPatterns(starts=[("strict", "IMPUESTO PREDIAL", 0.9), ("loose", "PREDIAL", 0.6)], ends=["CAPITULO"], blacklist="INDICE", look_back=30, least=10, most=60)
    far = "x" * 40
    rows = [("INDICE IMPUESTO PREDIAL 3 " + far + " IMPUESTO PREDIAL tasa CAPITULO",), ("😀 INDICE PREDIAL " + far + " PREDIAL tasa CAPITULO",), ("INDICE PREDIAL PREDIAL",), ("IMPUESTO PREDIAL" + "y" * 90 + "CAPITULO",), (None,)]
    got = [r.s for r in spark.createDataFrame(rows, "t string").select(segment.locate(F.col("t"), p).alias("s")).collect()]
    assert [(r.found, r.method, r.start) for r in got] == [(True, "strict", 67), (True, "loose", 58), (False, "none", None), (True, "strict", 0), (False, "none", None)]
    assert (got[3].end, got[3].confidence) == (106, 0.9)
    hooks = segment.SectionPatterns(starts=[("period", "\\. ", 0.9)], ends=["\n"], least=3, most=8, context_ok=lambda c: F.length(c).between(1, 59), section_ok=lambda c: c.rlike("[aeiou]"))
    texts = [(". b. tasa\n",), ("x. bcd\n. tasa\n",), ("x. bcd\n",)]
    assert [r.s.start for r in spark.createDataFrame(texts, "t string").select(segment.locate(F.col("t"), hooks).alias("s")).collect()] == [3, 7, None]
    empty = segment.match_sizes(F.col("t"), "(?=a)")
    assert [(x.gap, x.size) for x in spark.createDataFrame([("aba",)], "t string").select(empty.alias("m")).first().m] == [(0, 0), (2, 0)]


def test_deep_values_at_any_depth(spark):
    df = spark.createDataFrame([(1, '{"t": [{"rows": [{"rate": {"value": 25}}, 7]}, []], "n": null}'), (2, "[[[[[30]]]]]"), (3, None), (4, "5")], "k int, j string")
    got = {(r.k, r.path, r.value) for r in documents.deep_values(df, ["k"], "j").collect()}
    assert got == {(1, "t.0.rows.0.rate.value", "25"), (1, "t.0.rows.1", "7"), (1, "n", None), (2, "0.0.0.0.0", "30")}


def test_article_ranges(spark):
    law = ["Articulo 12. Impuesto", "Predial", "tasa", "Articulo 14. Impuesto", "Articulo 13. El Impuesto x", "Anexo 1"]
    rows = [(1, "\n".join(law)), (2, "Articulo 13. Impuesto\nArticulo 12. Impuesto Predial\na\nTransitorios\nb"), (3, "Anexo\nArticulo 12. Impuesto Predial"), (4, "Articulo 20: Impuesto Predial\na"), (5, "")]
    x = segment.lines(spark.createDataFrame(rows, "doc_id int, text string"), "doc_id", "text")
    lead = "^\\s*Articulo (%s)[.:] (?:El )?Impuesto%s"
    got = segment.article_ranges(x, "doc_id", lead % ("1[0-9]|20", " Predial"), lead % ("\\d+", ""), "^Anexo", "^Transitorios")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 12, 0, 3), (2, 12, 1, 3), (4, 20, 0, 1)]


def test_page_spans_and_edits(spark):
    cases = [(-3, 9, 5, None, 0, 5), (8, 2, 5, None, 4, 5), (1, 1, 9, None, 1, 4), (1, 8, 9, 4, 1, 4), (6, 8, 9, 4, 6, 8), (2, None, 9, None, 2, 5), (1, 2, 0, None, 0, 0)]
    df = spark.createDataFrame(cases, "s int, e int, n int, b int, first int, last int")
    assert all((r.x.first, r.x.last) == (r["first"], r["last"]) for r in df.withColumn("x", segment.page_span(F.col("s"), F.col("e"), F.col("n"), F.col("b"), 3)).collect())
    pages = spark.createDataFrame([(["a", "Sumario"],), (["a"] * 5 + ["SUMARIO"],)], "p array<string>").select(segment.skipped_pages(F.col("p"), "SUMARIO").alias("x"))
    assert [r.x for r in pages.collect()] == [2, 1]
    docs = spark.createDataFrame([(1, "u", None, "P"), (2, "v", "m", "F")], "k int, unit string, month string, tipo string")
    log = spark.createDataFrame([(1, "unidad=w; mes=enero; otro=1", "F"), (2, "", "F")], "k int, notes string, tipo_nuevo string")
    assert {tuple(r) for r in review.minor_edits(log, docs, "k", F.col("notes"), {"unidad": "unit", "mes": "month"}).collect()} == {(1, "unidad", "u", "w"), (1, "mes", "", "enero")}
    assert [tuple(r) for r in review.overrides(log, docs, "k", "tipo_nuevo", "tipo").collect()] == [(1, "tipo", "P", "F")]
