from pyspark.sql import functions as F

from panelspark.operators import identity, naming, segment, validation
from panelspark.plans import variant_queries


def test_outputs_in_one_pass(spark, sf, tmp_path):
    tagged = variant_queries.QUERIES["validation_run"](spark, sf)
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Window [") <= 3
    found = {r.output: r.n for r in tagged.groupBy("output").agg(F.count("*").alias("n")).collect()}
    assert set(found) == set(validation.OUTPUTS) and found["summary"] == found["schema_timeline"]
    validation.write_outputs(tagged, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {f"output={x}" for x in validation.OUTPUTS}
    switches = validation.output(tagged, "schema_switches")
    assert switches.columns == ["municipio", "anio", "de", "a"] and switches.filter("de = a").count() == 0
    kinds = {r.value for r in tagged.filter("output = 'summary'").select("value").distinct().collect()}
    assert kinds == {"tarifa_millar", "progresivo", "tasa_unica", "cuota_fija_simple", "cuota_fija_escalonada", "mixto", "otro_no_clasificado"}


def test_empty_validation(spark, sf):
    docs = variant_queries._first_form(spark, sf).limit(0).withColumns({"entity": F.lit("a"), "year": F.lit(2000), "path": F.lit("")})
    assert validation.outputs(docs, "entity", "year", "l_orderkey", "path").count() == 0


def test_sections_of_patterns_as_data(spark):
    rows = [("a", "start", 1, "section", "SECCION +PREDIAL", 0.9, None), ("a", "start", 2, "word", "PREDIAL", 0.7, "ARTICULO [0-9]"), ("a", "end", 1, "", "SECCION SEGUNDA", 0.0, None), ("a", "blacklist", 1, "", "INDICE", 0.0, None), ("b", "start", 1, "other", "TAX", 0.8, None)]
    patterns = spark.createDataFrame(rows, "state string, kind string, rank int, name string, pattern string, confidence double, needs string")
    filler = "x" * 60
    docs = [
        (1, "a", ["first page", f"SECCION PREDIAL {filler}", f"SECCION SEGUNDA {filler} {filler}"]),
        (2, "a", ["PREDIAL nothing", f"PREDIAL ARTICULO 3 {filler}", "y" * 200]),  # the first match lacks what must follow
        (3, "a", ["INDICE SECCION PREDIAL", "no", "more", "of", "it"]),  # behind a blacklisted text
        (4, "a", ["y" * 300, "SECCION PREDIAL"]),  # in the second half
        (5, "b", [f"TAX {filler}"]),
        (6, "c", ["no list", "of its own"]),
        (7, "a", []),
        (8, "a", None),
    ]
    df = spark.createDataFrame(docs, "id int, state string, pages array<string>")
    got = {r.id: r for r in segment.locate_by_lists(df, patterns, "state", "pages", least=10, most=100, look_back=20, fallback_pages=2).collect()}
    assert (got[1].method, got[1].start, got[1].page_start, got[1].page_end, got[1].confidence) == ("section", 11, 1, 2, 0.9)
    assert (got[2].method, got[2].page_start, got[2].confidence) == ("word", 0, 0.56) or (got[2].method, got[2].start) == ("word", 0)
    assert (got[3].method, got[3].start, got[3].page_end) == ("fallback_2pp", 0, 2) and (got[4].method, got[4].found) == ("fallback_2pp", True)
    assert got[5].method == "other" and got[6].method == "fallback_2pp" and got[6].end == len("no list\nof its own")
    assert [(got[i].found, got[i].method, got[i].start) for i in (7, 8)] == [(False, "no_text", None)] * 2


def test_headings(spark):
    headings = [
        (1, "Ley de Ingresos del Municipio de San Juan Bautista Valle Nacional Tuxtepec para el Ejercicio Fiscal 2019"),
        (2, "LEY DE INGRESOS DEL MUNICIPIO DE SANTA MARÍA; DISTRITO DE POCHUTLA, OAXACA."),
        (3, "LEY DE INGRESOS DEL MUNICIPIO DE MIAHUATLÁN DE PORFIRIO DÍAZ"),  # an alias alone is a name
        (4, "otra cosa"),
        (5, None),
        (6, "LEY DE INGRESOS DE LA CIUDAD DE PORFIRIO DIAZ PARA SU EJERCICIO LEGAL DEL 2021"),
    ]
    aliases = spark.createDataFrame([("Tuxtepec",), ("Nacional Tuxtepec",), ("Miahuatlan de Porfirio Diaz",), ("porfirio díaz",)], "alias string")
    got = {r.id: tuple(r)[1:] for r in naming.named(spark.createDataFrame(headings, "id int, h string"), "id", "h", aliases, "alias").collect()}
    assert got == {
        1: ("San Juan Bautista Valle", "Nacional Tuxtepec", 2019, "NACIONAL TUXTEPEC"),
        2: ("SANTA MARÍA", "POCHUTLA", None, ""),
        3: ("MIAHUATLÁN DE", "PORFIRIO DÍAZ", None, "PORFIRIO DIAZ"),
        4: ("", "", None, ""),
        5: ("", "", None, ""),
        6: ("LA CIUDAD DE", "PORFIRIO DIAZ", 2021, "PORFIRIO DIAZ"),
    }


def test_names_and_catalog_are_worked_out_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def slug(x):
        calls.add(1)
        return x

    made = F.udf(slug, "string")
    cat = spark.createDataFrame([("s", n, i) for i, n in enumerate(("saltillo", "valle_de_bravo", "guadalajara", "torreon"))], "block string, name string, key long").withColumn("name", made("name"))
    names = spark.createDataFrame([("s", n) for n in ("saltillo", "valle_bravo", "guadalajra", "toreon", "qqq")], "block string, name string").withColumn("name", made("name"))
    got = {r.name: (r.key, r.stage) for r in identity.match_names(names, cat, "block", "name", "key", least_ratio=0.55).collect()}
    assert got == {"saltillo": (0, "exact"), "valle_bravo": (1, "words"), "guadalajra": (2, "ratio"), "toreon": (3, "ratio"), "qqq": (None, "none")}
    assert calls.value == 9
