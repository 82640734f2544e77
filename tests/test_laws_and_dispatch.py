import random
import re

from pyspark.sql import functions as F

from panelspark.operators import dispatch, laws, segment
from panelspark.plans import registry
from panelspark.plans.review_queries import INDEX


def test_laws_over_lines_against_a_scan(spark):
    p = laws.LawPatterns(title=r"LEY DE ([a-z]+)(?: (\d{4}))?", year=r"EJERCICIO\s+(\d{4})", needed=r"Articulo\s+1", refused=r"expido y", window=3, year_ahead=5, needed_ahead=6, look_back=3, apart=4)
    rng = random.Random(3)
    words = ["LEY DE leon", "LEY DE", "leon 2012", "EJERCICIO 2011", "EJERCICIO", "2013", "Articulo 1", "Articulo", "1", "expido y", "", "nada", "LEY DE colima"]
    docs = [(i, "\n".join(rng.choice(words) for _ in range(rng.randrange(0, 40)))) for i in range(60)] + [(60, None), (61, "")]

    def scan(text):
        ls, out, seen, last = text.split("\n"), [], set(), None
        for i in range(len(ls)):
            m = re.search(p.title, " ".join(x.strip() for x in ls[i : i + 3] if x.strip()))
            if not m:
                continue
            year = m[2] or ""
            if not year and (y := re.search(p.year, "\n".join(ls[i : i + 5]))):
                year = y[1]
            if not re.search(p.needed, "\n".join(ls[i : i + 6])) or re.search(p.refused, "\n".join(ls[max(0, i - 3) : i + 1])):
                continue
            if (m[1], year) in seen and i - last < 4:
                continue
            seen.add((m[1], year))
            last = i
            out.append((i, m[1], year))
        return out

    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {}
    for r in laws.laws(segment.lines(df, "doc_id", "text"), "doc_id", p).collect():
        got.setdefault(r.doc_id, []).append((r.line_no, r.name, r.year))
    assert {k: sorted(v) for k, v in got.items()} == {i: scan(t) for i, t in docs if t and scan(t)}
    assert sum(map(len, got.values())) > 40


def test_law_span_leaves_the_summary(spark):
    body = "SUMARIO LEY DE a b. NUMERO 1 LEY DE c uno NUMERO 2 LEX NUMERO 3 LEY DE a.b dos LEY DE a  b tres"
    rows = [(body, "a b"), (body, "c"), (body, "a.b"), (body, "zz"), (body, ""), (None, "c"), (body, None), ("LEY DE c x LEY DE d", "c")]
    span = laws.law_span(F.col("t"), F.col("n"), r"NUMERO \d LEY DE ", r"LEY DE\s+")
    got = [None if r.s is None else r.t[r.s.start : r.s.end] for r in spark.createDataFrame(rows, "t string, n string").select("t", span.alias("s")).collect()]
    assert got == ["LEY DE a  b tres", "NUMERO 1 LEY DE c uno NUMERO 2 LEX ", "NUMERO 3 LEY DE a.b dos ", None, None, None, None, "LEY DE c x "]


def test_page_sections(spark):
    p = laws.PagePatterns(full="del impuesto predial", short="predial", section="seccion (primera|[ivx]+)", chapter="capitulo", matter="impuesto", parent="sobre el patrimonio", article="articulo", ruled_out="indice", following="impuesto sobre nominas", following_start="^del impuesto")
    pages = {
        "plain": ["portada", "Sección\nSECCION  I\nPREDIAL\narticulo 1", "x", "del impuesto sobre nominas"],
        "next page": ["seccion primera\ndel impuesto predial", "articulo 5", "x", "x", "x", "x", "x"],
        "ruled out": ["indice\nseccion i\npredial\narticulo 1"],
        "no article": ["seccion i\npredial", "", "articulo 1"],
        "parent": ["sobre el patrimonio\narticulo 2\ndel impuesto predial"],
        "far": ["seccion i\na\nb\nc\nd\ne\npredial\narticulo 1"],
        "empty": [""],
    }
    rows = [(k, i, n, line) for k, ps in pages.items() for i, page in enumerate(ps) for n, line in enumerate(page.split("\n"))]
    got = {r.k: (r.pages, r["first"], r["last"], r.next, r.forced, r.expanded) for r in laws.page_sections(spark.createDataFrame(rows, "k string, page int, line_no int, line string"), "k", p).collect()}
    none = (None, None, None, None, None)
    assert got == {
        "plain": (4, 1, 2, 3, False, True), "next page": (7, 0, 4, None, True, True), "ruled out": (1, *none), "no article": (3, *none),
        "parent": (1, 0, 0, None, True, True), "far": (1, *none), "empty": (1, *none),
    }


def test_review_books_with_open_and_odd_blocks(spark):
    book = "intro\n### `a_b/c1/2010`(cvegeo 7)\n- [ x] revisado\n- veredicto: incorrecto.\n- causa_raiz: API error, x\n- patron: p-12 y P-13\n### otra cosa\n- veredicto: correct\n### `x/y/20`(cvegeo 1)\n### `z/z/2011` (cvegeo 8)\n- [ ] revisado\n- veredicto:\n- notas: n\n"
    df = spark.createDataFrame([(1, book), (2, None), (3, "")], "id long, t string")
    got = [(r.id, r.slug, r.anio, r.revisado, r.veredicto, r.causa_raiz, r.patron, r.notas) for r in laws.book_cases(df, "id", "t").orderBy("n").collect()]
    assert got == [(1, "c1", 2010, True, "incorrecto", "api_error", "P-12", ""), (1, "z", 2011, False, "", "", "", "n")]
    patterns = "## Patrones detectados\n### P-01 x\n- **estado**: abierto\n### sin id\n### P-02\n"
    df = spark.createDataFrame([(1, patterns + "\n## Otra\n### P-03\n"), (2, "## Patrones detectados\n### P-04\n- **casos**: 3")], "id long, t string")
    assert sorted((r.id, r.patron, r.estado, r.casos) for r in laws.book_patterns(df, "id", "t").collect()) == [(1, "P-01", "abierto", ""), (1, "P-02", "", ""), (2, "P-04", "", "3")]


def test_index_hits_against_python(spark, sf):
    header, hit, year, tail = INDEX
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        heads = list(re.finditer(header, r.text or ""))
        for i, h in enumerate(heads):
            body = r.text[h.end() : heads[i + 1].start() if i + 1 < len(heads) else len(r.text)]
            for m in re.finditer(hit, body):
                y = re.search(year, body[m.end() : m.end() + tail])
                want.append((r.doc_id, i, h[1], m[1], y[1] if y else ""))
    got = [tuple(r) for r in registry.queries()["index_hits"](spark, sf).select("doc_id", "block", "header", "hit", "year").collect()]
    assert sorted(got) == sorted(want) and want


def test_batches_close_at_limits(spark):
    rng = random.Random(5)
    rows = [(g, i, rng.randrange(0, 60)) for g in (1, 2, None) for i in range(200)]
    want = {}
    for g in (1, 2, None):
        batch = used = n = 0
        for _, i, s in (r for r in rows if r[0] == g):
            if n and (used + s > 100 or n >= 4):
                batch, used, n = batch + 1, 0, 0
            used, n = used + s, n + 1
            want[g, i] = batch
    df = segment.packed(spark.createDataFrame(rows, "g long, i long, s long").repartition(7), "g", "i", "s", 100, 4)
    assert {(r.g, r.i): r.batch for r in df.collect()} == want


def test_decisions_in_full(spark):
    rows = [
        ("a", 1, 2010, "propagar_previo", "", None), ("b", 2, 2010, "propagar_previo", "", None), ("c", 1, 2009, "Corregir_previo ", "cambio_menor", "unidad=x"),
        ("d", 9, 2010, "sin_ley", "", None), ("e", 1, 2010, "sin_ley", None, None), ("f", 1, 2010, "re_segmentar", "", "sin paginas"), ("g", 1, 2010, "re_segmentar", "", "paginas = 3, 5-6; pdf = x.pdf"),
        ("h", 9, 2010, "reextraer", "", None), ("i", 1, 2010, None, "", None), ("j", 1, 2010, "no", "", None),
    ]
    decided = spark.createDataFrame(rows, "id string, entity long, year long, decision string, option string, notes string")
    documents = spark.createDataFrame([(1, 2009), (1, 2010), (2, 2010)], "entity long, year long")
    routes = dispatch.routed(decided, documents)
    got = {r.id: r for r in routes.collect()}
    assert {k: r.outcome for k, r in got.items()} == dict(a="done", b="error", c="done", d="done", e="done", f="error", g="done", h="done", i="undecided", j="invalid")
    assert (got["a"].copy_from, got["a"].copy_to) == (2009, 2010) and (got["c"].copy_from, got["c"].copy_to, got["c"].minor) == (2009, 2008, True)
    assert (got["g"].pages, got["g"].pdf) == ("3, 5-6", "x.pdf") and not got["d"].closes and got["e"].closes and got["h"].hint is None
    assert {k: sorted(r.id for r in v.collect()) for k, v in dispatch.outputs(routes).items()} == {
        "log": list("acdegh"), "copies": ["a", "c"], "edits": ["c"], "overrides": ["g"], "queue": ["g", "h"], "closed": ["e"], "failures": ["b", "f", "j"],
    }
    assert routes.count() == len(rows)
