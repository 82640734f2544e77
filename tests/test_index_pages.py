import pytest
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from panelspark.operators import markup, phrases
from panelspark.plans import index_queries


class Slow(HTMLParser):
    """Cells by a stack: what a tag opens belongs to the last table or list that is open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.n, self.out = [], 0, []

    def handle_starttag(self, tag, attrs):
        top = self.stack[-1] if self.stack else None
        if tag in markup.CONTAINERS:
            self.n += 1
            self.stack.append({"kind": "table" if tag == "table" else "list", "number": self.n, "row": 0, "cell": 0, "open": None, "depth": len(self.stack) + 1})
        elif top and tag == ("tr" if top["kind"] == "table" else "li"):
            top["row"] += 1
            top["cell"], top["open"] = 0, None
            if tag == "li":
                self.begin(top)
        elif top and top["kind"] == "table" and tag in ("td", "th"):
            self.begin(top)
        elif top and top["open"] is not None and tag == "a" and top["open"]["href"] is None:
            top["open"]["href"] = dict(attrs).get("href")
        elif top and top["open"] is not None and tag in ("br", "p", "div"):
            top["open"]["text"] += " "

    def begin(self, top):
        top["cell"] += 1
        top["open"] = {"text": "", "href": None, **{k: top[k] for k in ("kind", "number", "depth", "row", "cell")}}
        self.out.append(top["open"])

    def handle_endtag(self, tag):
        top = self.stack[-1] if self.stack else None
        if tag in markup.CONTAINERS:
            if self.stack:
                self.stack.pop()
        elif top and (top["kind"] == "table" and tag in ("td", "th", "tr") or top["kind"] == "list" and tag == "li"):
            top["open"] = None
        elif top and top["open"] is not None and tag in ("p", "div", "br"):
            top["open"]["text"] += " "

    def handle_data(self, data):
        if self.stack and self.stack[-1]["open"] is not None and not self.cdata_elem:
            self.stack[-1]["open"]["text"] += data


def slow(pages):
    out = []
    for page, html in pages:
        s = Slow()
        s.feed(html or "")
        s.close()
        out += [(page, c["kind"], c["number"], c["depth"], c["row"], c["cell"], " ".join(c["text"].split()), c["href"]) for c in s.out]
    return sorted(out, key=str)


def test_cells_against_the_standard_parser(spark, sf):
    rng = random.Random(3)
    parts = ["<table class=a>", "</table>", "<tr>", "</tr>", "<td>", "<TD colspan='2'>", "</td>", "<th>", "<ul>", "</ul>", "<ol>", "</ol>", "<li>", "</li>", "<a href='/x?a=1&amp;b=2'>", '<a class=c HREF="/y z">', "<a href=/z>", "<a name=n>", "</a>", "<br>", "<p>", "text", " more &amp; &eacute;&#233;&#xe9; ", "\n", "<b>", "</b>", "<!-- <table><tr><td> -->", "<script>'<td>'</script>"]
    pages = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(60)))) for i in range(300)] + [(1000, None), (1001, ""), (1002, "no tables")]
    pages += [(2000 + r.page_id, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()] + [(9000 + r.page_id, r.html) for r in index_queries._index_pages(spark, sf).limit(5).collect()]
    got = markup.cells(spark.createDataFrame(pages, "page long, html string"), "page", "html")
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow(pages)


def test_one_shuffle_for_all_windows(spark):
    plan = markup.cells(spark.createDataFrame([(1, "<ul><li>a</ul>")], "page long, html string"), "page", "html")
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(page") == 1


def test_unescaped(spark):
    texts = ["a &amp;amp; b", "&unknown; &nbsp;x &#8364;&#x1F600; &#;&", "R&D &copy", None, ""]
    got = [r.t for r in spark.createDataFrame([(t,) for t in texts], "t string").select(markup.unescaped(F.col("t")).alias("t")).collect()]
    assert got == ["a &amp; b", "&unknown;  x €😀 &#;&", "R&D &copy", None, ""]


def test_phrases_against_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 5)))
    texts = [(i, f"b{i % 2}", " ".join(word() for _ in range(rng.randrange(12)))) for i in range(200)] + [(900, "b0", None), (901, "b0", "")]
    wanted = [(f"b{i % 2}", " ".join(word() for _ in range(rng.randrange(1, 5)))) for i in range(150)] + [("b0", ""), ("b1", None), ("b1", "a  b")]
    want = {(b, i, p) for i, b, t in texts for c, p in wanted if b == c and p and t and p in t}
    got = phrases.texts_with(spark.createDataFrame(texts, "i long, block string, t string"), spark.createDataFrame(wanted, "block string, phrase string"), "i", "t", "phrase", "block")
    assert {(r.block, r.i, r.phrase) for r in got.collect()} == want and got.count() == len(want)
    assert phrases.texts_with(spark.createDataFrame(texts, "i long, block string, t string"), spark.createDataFrame([], "phrase string"), "i", "t", "phrase").count() == 0


def test_search_terms(spark):
    rows = [("agua_prieta", None), ("general_plutarco_elias_calles", "Gral.  Plutarco Elías"), ("heroica_caborca", "H. Caborca"), ("ures", ""), ("abc", "x")]
    got = [set(r.t) for r in spark.createDataFrame(rows, "s string, r string").select(phrases.search_terms(F.col("s"), F.col("r")).alias("t")).collect()]
    assert got == [{"agua prieta"}, {"general plutarco elias calles", "plutarco elias calles", "gral plutarco elias calles", "gral. plutarco elias calles", "gral. plutarco elias"}, {"heroica caborca", "caborca", "h. caborca"}, {"ures"}, set()]


def test_every_status_occurs(spark, sf):
    got = index_queries.QUERIES["expected_against_found"](spark, sf)
    assert {r.status for r in got.select("status").distinct().collect()} == {"ok", "partial", "mismatch", "no_text", "missing_file"}


def test_pages_in_parts_are_read_as_whole_ones(spark):
    head = "</ul><!-- <table> --><table><tr><th>Ver<th>Fecha</tr>"
    pages = {
        1: [head, "<tr><td><a href='/a?x=1&amp;y'>uno</a><td>dos<ul><li>p<li>q</ul>&eacute;</tr>", "<tr><td>tres</tr></table>", "</table><ul><li>r</li></ul><ol><li>x"],
        2: ["<ul>", "<li>a</li><li>b</li>", "</ul><table>", "</table></table>", "<table><td>before any row</td>", "<tr><td>c"],
        3: ["text only"],
        4: ["<table><tr><td>o</td>", "<td>next<br>cell</td><table>", "<tr><td>inner</td></tr></table>", "</tr><tr><td>last</td></tr></table> end"],
    }
    whole = spark.createDataFrame([(k, "".join(x)) for k, x in pages.items()], "k long, html string")
    parts = spark.createDataFrame([(k, i, x) for k, xs in pages.items() for i, x in enumerate(xs)], "k long, n int, html string").repartition(5)
    got = lambda df: sorted(tuple("" if v is None else v for v in r) for r in df.collect())
    want = got(markup.cells(whole, "k", "html"))
    assert got(markup.cells(parts, "k", "html", "n")) == want and len(want) == 17
    assert (1, "table", 1, 1, 2, 2, "dosé", "") in want and (1, "table", 1, 1, 2, 1, "uno", "/a?x=1&y") in want and (2, "table", 3, 1, 0, 1, "before any row", "") in want


def test_a_page_cut_inside_a_cell_is_refused(spark):
    parts = spark.createDataFrame([(1, 1, "<table><tr><td>a"), (1, 2, "b</td></tr></table>")], "k long, n int, html string")
    with pytest.raises(Exception, match="cut inside a cell"):
        markup.cells(parts, "k", "html", "n").collect()
