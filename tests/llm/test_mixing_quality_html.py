import re
import time
import tracemalloc
import zlib
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelspark.llm import arrowtext, html_extract, mixing, quality
from tests.llm import edge


def test_mix_targets_and_takes(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix_sources(df).collect()
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in df.collect()}
    source = {r.doc_id: r.source for r in df.collect()}
    total = {}
    for d, s in source.items():
        total[s] = total.get(s, 0) + sizes[d]
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sorted(total))}
    budget, target, open_ = 1.5 * sum(total.values()), {}, set(total)
    while True:
        left = budget - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * total[s]}
        if not over:
            target |= share
            break
        target |= {s: 2.0 * total[s] for s in over}
        open_ -= over
    took = {}
    for r in rows:
        assert r.size == sizes[r.doc_id] and r.source_size == total[source[r.doc_id]] and abs(r.target - target[source[r.doc_id]]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size and r.taken % max(r.size, 1) == 0
        took[source[r.doc_id]] = took.get(source[r.doc_id], 0) + r.taken
    for s in total:
        assert abs(took[s] - target[s]) <= max(n for d, n in sizes.items() if source[d] == s)
    again = {(r.doc_id, r.taken) for r in mixing.mix_sources(df.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_mix_edges(spark):
    rows = mixing.mix_sources(edge.docs(spark)).collect()
    assert len(rows) == len(edge.ROWS) and all(r.taken == 0 for r in rows if r.size == 0)
    assert mixing.mix_sources(edge.empty(spark)).count() == 0
    out = mixing.mixed(edge.docs(spark))
    assert out.columns == edge.docs(spark).columns
    copies = {}
    for r in out.collect():
        copies[(r.doc_id, r.text)] = copies.get((r.doc_id, r.text), 0) + 1
    want = {}
    for r, t in ((r, t) for r in rows for t in [x[1] for x in edge.ROWS if x[0] == r.doc_id and mixing.hashlib.md5((x[1] or "").encode()).hexdigest() == r._tie][:1]):
        if r.copies:
            want[(r.doc_id, t)] = want.get((r.doc_id, t), 0) + r.copies
    assert copies == want


def test_weights_follow_quality(spark):
    rows = [(i, "good words here only " * 5 if i % 2 else "*** &&& %%% $$$ " * 5, "s") for i in range(4000)]
    rows += [(9000 + i, "x " * 20, "t") for i in range(2000)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1.0, 9.0), share=0.8).collect()
    half = [r for r in got if r.doc_id < 9000]
    good = sum(r.taken > 0 for r in half if r.doc_id % 2)
    assert good > 3 * sum(r.taken > 0 for r in half if r.doc_id % 2 == 0)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.quality_scores(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.98
    assert np.mean([r.predicted == 0 for r in held if r.quality == 0]) > 0.9


def test_words_in_a_row_count_up_to_renaming():
    """No word of what is scored was ever seen: what tells is which words are the same."""
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    texts = [" ".join([word()] * 40) if i % 2 else " ".join(word() for _ in range(40)) for i in range(300)]
    worth, bias = quality.train(texts[:200], np.arange(200) % 2)
    scores = quality.score_column(pa.array(texts[200:]), worth, bias)
    assert ((scores >= 0.5) == (np.arange(100) % 2 == 1)).mean() > 0.95


def test_the_same_rows_are_drawn_in_each_run(spark, monkeypatch):
    drawn = []
    monkeypatch.setattr(quality, "train", lambda texts, labels: drawn.append((texts, labels.tolist())) or (np.zeros(quality.BUCKETS, np.float32), 0.0))
    rows = [(i % 40, f"text {i}") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    for parts in (1, 7):
        quality.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), labels)
    assert drawn[0] == drawn[1] and len(drawn[0][0]) == len([i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1])


def slow_bag(text):
    """Buckets of a text's features, one by one."""
    def bucket(x):
        x &= 2**64 - 1
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 % 2**64
        x ^= x >> 27
        x = x * 0x94D049BB133111EB % 2**64
        x ^= x >> 31
        return x >> 46

    assert quality.BUCKETS == 2**18
    one = re.sub(r"[\x20\x09-\x0D]+", " ", text).encode()
    raws = [np.frombuffer(w, np.uint8) for w in one.split(b" ") if w]
    h = [int(arrowtext.hashes(r, arrowtext.words(r, np.array([0, len(r)]), arrowtext.NOT_SPACE), fold=False)[0]) for r in raws]
    out = [bucket(x ^ 0xABCD) for x in h] + [bucket(a * 0x9E3779B97F4A7C15 + b) for a, b in zip(h, h[1:])]
    for i in range(len(h) - quality.RUN + 1):
        run, key = h[i : i + quality.RUN], 0x5EED
        for x in run[1:]:
            key = key * quality.RUN + run.index(x)
            key %= 2**64
        out.append(bucket(key))
    return out + [bucket(int.from_bytes(one[i : i + k], "little") ^ k << 56) for k in quality.GRAMS for i in range(len(one) - k + 1)]


def test_features_and_scores_against_slow_ones(monkeypatch):
    texts = [r[1] or "" for r in edge.ROWS if len(r[1] or "") < 1000] + [" a  b\t\nc ", "\n", "ab", "word " * 40 + "x" * 30]
    rng = np.random.default_rng(1)
    worth = rng.normal(size=quality.BUCKETS).astype(np.float32)
    want = []
    for t in texts:
        b = slow_bag(t)
        want.append(1 / (1 + np.exp(-(float(np.mean([worth[x] for x in b])) if b else 0.0) - 0.25)))
        ids, part = quality.bag(t)
        assert {int(i): round(float(p) * len(b)) for i, p in zip(ids, part)} == {x: b.count(x) for x in set(b)}
    for piece in (16, 1 << 18):
        monkeypatch.setattr(quality, "PIECE", piece)
        assert np.allclose(quality.score_column(pa.array(texts), worth, 0.25), want)


def test_very_long_text_is_scored_in_bounded_memory():
    text = "Some words, and more of them. " * 700_000
    tracemalloc.start()
    score = quality.score_column(pa.array([text], pa.large_string()), np.zeros(quality.BUCKETS, np.float32), 0.0)
    assert score[0] == 0.5 and tracemalloc.get_traced_memory()[1] < 60 * len(text)
    tracemalloc.stop()


def test_quality_edges(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(edge.docs(spark), none).collect()
    assert len(got) == len(edge.ROWS) and {r.score for r in got} == {0.5}
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (3, 0), (8, 1), (9, 0), (12, 1)], "doc_id long, quality int").withColumn("text", F.lit("clash"))
    got = quality.quality_scores(edge.docs(spark), labels).collect()
    assert len(got) == len(edge.ROWS) and all(0 <= r.score <= 1 for r in got)
    assert quality.quality_scores(edge.empty(spark), labels).count() == 0
    assert quality.good_documents(edge.docs(spark), none).columns == edge.docs(spark).columns


PAGES = [
    ('<html><body><nav><a href="/">Home, sweet, home</a></nav><div id="page"><div class="content"><h2>Title &amp; more</h2><p>First paragraph, long enough, with commas and words to count.<p>Second &lt;b&gt; one,\n with   space&nbsp;here and <b>bold</b>.<br>Broken line.<ul><li>a<li>b</ul></div><div class="comments"><p>I disagree, strongly, with all of this, really, I do.</p></div></div><footer>&copy; me</footer></body></html>', "Title & more\nFirst paragraph, long enough, with commas and words to count.\nSecond <b> one, with space here and bold. Broken line.\na\nb"),
    ('<article><header><h1>Head</h1></header><p>Short.</p><aside>side</aside><form>f</form><script>var t="</p>";</script><p>Body text of the article, which is the longest of them all, surely.</p></article><div class="ad">Buy, buy, buy, now, now, now, please, please, please, do.</div>', "Head\nShort.\nBody text of the article, which is the longest of them all, surely."),
    ("", ""),
    (None, ""),
    ("<p></p><br>", ""),
    ("plain text without any tag, but with a comma", "plain text without any tag, but with a comma"),
    ("<div>" * 3000 + "deep text, that is read without recursion" + "</div>" * 3000, "deep text, that is read without recursion"),
    ("<p>unclosed <b>bold <i>it</p><p>next</p>", "unclosed bold it\nnext"),
    ("<table><tr><td>one, cell with some text in it<td>two</table>", "one, cell with some text in it\ntwo"),
]


@pytest.mark.parametrize("html,want", PAGES)
def test_main_text(html, want):
    assert html_extract.main_text(html) == want


def test_pages(spark):
    rows = [(i, f"u{i}", h) for i, (h, _) in enumerate(PAGES)] + [(None, None, PAGES[1][0]), (1, "u1", PAGES[1][0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("x"), "n_chars": F.lit(1)})
    got = html_extract.extract_main_text(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got if r.page_id is not None} == {i: t for i, (_, t) in enumerate(PAGES)}
    assert html_extract.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


PROSE = "A sentence of some length, with a comma, that reads as prose and goes on for a while. " * 4
LEAD = "Words of a lead without any comma that only tell what the article is about " * 3
LINKS = "".join(f'<a href="/{i}">Item number {i}</a> ' for i in range(9))
LOOSE = [
    (f"<div><div><p>{LEAD}</p></div><div><p>{PROSE}</p><p>{PROSE}</p></div><div>{LINKS}</div></div>", [LEAD, PROSE, PROSE]),
    (f"<body>{LINKS}<div><div><p>{LEAD}</p></div></div><div><div>Bare <b>words</b> here<div><p>{PROSE}</p><p>{PROSE}</p></div></div></div></body>", [LEAD, "Bare words here", PROSE, PROSE]),
    (f'<article><div class="article-header"><h1>Title</h1></div><p>{PROSE}</p><section id="discussion"><h2 id="search">Search</h2><p class="alert">{LEAD}</p></section><div class="related">Related {LINKS}</div><div class="comment">I disagree</div><div class="share" >{LINKS}</div></article>', ["Title", PROSE, "Search", LEAD]),
    (f'<div class="alert">Cookies</div><div class="body"><h2 id="related">Related work</h2><p>{PROSE}</p></div>', ["Related work", PROSE]),
    (f'<article><p>{PROSE}</p><div class="share newsletter">{LEAD}</div></article>', [PROSE]),
]


@pytest.mark.parametrize("html,want", LOOSE)
def test_main_text_of_loose_pages(html, want):
    assert html_extract.main_text(html) == "\n".join(x.strip() for x in want)


NAMED = [
    (f'<article><h2 id="related-work">Related work</h2><p>{PROSE}</p><section id="search-methods"><p>{LEAD}</p></section><p class="notice-date">3 May</p></article>', ["Related work", PROSE, LEAD, "3 May"]),
    (f'<body><div class="no-sidebar"><p>{PROSE}</p><p>{LEAD}</p></div></body>', [PROSE, LEAD]),
    (f'<body><div class="header-image-wrapper"><div><p>{PROSE}</p><p>{PROSE}</p></div></div></body>', [PROSE, PROSE]),
    (f'<body id="x"><div id="main-menu-open"><article><p>{PROSE}</p></article></div></body>', [PROSE]),
    (f'<main><p>{PROSE}</p><ul><li><a href="1">Other story one</a><li><a href="2">Other story two</a></ul></main>', [PROSE]),
    (f'<main><div><p>{PROSE}</p></div><ul class="teasers"><li><a href="1">Other story one</a><li><a href="2">Other story two</a></ul></main>', [PROSE]),
    (f'<main><header><h1>Title</h1></header><p>{PROSE}</p><article class="comment"><p>{PROSE}</p></article></main><div class="comments"><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></div>', ["Title", PROSE]),
    (f'<form><article><p>{PROSE}</p></article></form>', [PROSE]),
]


@pytest.mark.parametrize("html,want", NAMED)
def test_class_words_drop_nothing_by_themselves(html, want):
    assert html_extract.main_text(html) == "\n".join(x.strip() for x in want)


def test_pages_against_brute_force(spark, sf):
    """Pages of the tables hold one article; its blocks are found by splitting at the tags of blocks."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract_main_text(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [unescape(re.sub(r"<[a-z/][^>]*>", lambda m: " " if m[0] == "<br>" else "", x)) for x in re.split(r"</?(?:p|h[1-6]|div|ul|ol|li|section|blockquote|pre|table|tr|td)\b[^>]*>", inside)]
        assert got[r.page_id] == "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def test_scores_against_slow_ones(spark, sf):
    """The points of an element by its definition: over all blocks below it, each with the way from the element to the block."""
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").limit(20).collect()] + [h for h, _ in [*PAGES[:2], *LOOSE, *NAMED]]
    for html in pages:
        tree = html_extract.Tree()
        tree.feed(html)
        nodes = html_extract._in_order(tree.root)
        html_extract._spare_articles(nodes)
        html_extract._score(tree.root, nodes)
        want = {id(n): [0.0, 0, 0] for n in nodes}
        for block, text, linked in html_extract._runs(tree.root):
            chain = [block]
            while chain[-1].parent is not None:
                chain.append(chain[-1].parent)
            weight = float(np.prod([html_extract.LOWER[n.doubt] for n in chain]))
            points = weight * (0.1 if len(text) < 25 else 1 + sum(c in ",，" for c in text) + min(len(text) / 100, 3))
            first = 1 if block.tag in html_extract.TEXT_BLOCKS and len(chain) > 1 else 0
            for n, share in zip(chain[first:], (1, 1 / 2, 1 / 6, 1 / 9, 1 / 12)):
                want[id(n)][0] += points * share
            for n in chain:
                want[id(n)][1] += len(text)
                want[id(n)][2] += min(linked, len(text))
        for n in nodes:
            if not n.drop:
                assert abs(n.score - want[id(n)][0]) < 1e-9 and [n.chars, n.linked] == want[id(n)][1:]


MARKUP = [
    "a < b <c d='1' E=\"2 > 1\" f=g/h i>x</C ><br/>y<div/>z", "<!-- a > b -->t<!DOCTYPE html><?pi x>w</p >", "<script>if (a < b) '</p>';</script >s<style></STYLE>", "<p class=a&amp;b title='&lt;'>&copy;&nbsp;&#x41;&unknown; R&D</p>",
    "<a =x b=y c = 'z' / d>l</a>",
]


@pytest.mark.parametrize("html", MARKUP)
def test_tags_are_read_as_the_standard_parser_reads_them(html):
    class Standard(HTMLParser):
        def handle_starttag(self, tag, attrs):
            seen.append(("start", tag, attrs))

        def handle_endtag(self, tag):
            seen.append(("end", tag))

        def handle_data(self, data):
            seen.append(("data", data))

    class Own(html_extract.Tree):
        handle_starttag, handle_endtag, handle_data = Standard.handle_starttag, Standard.handle_endtag, Standard.handle_data

    def joined(events):
        out = []
        for e in events:
            if e[0] == "data" and out and out[-1][0] == "data":
                out[-1] = ("data", out[-1][1] + e[1])
            elif e != ("end", "br"):
                out.append(e)
        return out

    seen = []
    standard = Standard()
    standard.feed(html)
    standard.close()
    want, seen = joined(seen), []
    Own().feed(html)
    assert joined(seen) == want


def test_raw_text_and_short_comments():
    assert html_extract.main_text("<p>One<!--> two<!---> three</ x> four.</p><title>a <b></title><textarea><p></textarea>") == "One two three four."


@pytest.mark.parametrize("part", ["<a ", "<!--", "<!", "</", "</a", "<a href=\"", "<a href='x", "<script>", "<style>a", "<", "<a b=", "<a / = ", "<!-- -", "&", "<title>"])
def test_unclosed_markup_takes_linear_time(part):
    began = time.time()
    for end in ("", ">", "-->", '">'):
        html_extract.main_text("<p>Text before, of some length, with commas.</p>" + part * 100_000 + end)
    assert time.time() - began < 8


BESIDE = [
    ("<article><div><p>LONG</p></div><p>See <a href=x>the earlier report on the reservoir levels</a> too.</p></article>", "LONG\nSee the earlier report on the reservoir levels too."),
    ('<main><p>LONG</p><blockquote><a href=x>Quoted, from another page</a></blockquote></main>', "LONG\nQuoted, from another page"),
    ('<div class="post"><div class="text"><p>LONG</p></div><div class="text"><p>See <a href=x>the earlier report</a> on it, too.</p></div></div>', "LONG\nSee the earlier report on it, too."),
    ('<div class="post"><div class="text"><p>LONG</p></div><div class="more"><a href=x>One</a> <a href=y>Two</a></div></div>', "LONG"),
]


@pytest.mark.parametrize("html,want", BESIDE)
def test_paragraphs_stay_whatever_their_links(html, want):
    long = "A long paragraph of the article, with commas, words, and enough of them to score well above all else here. " * 3
    assert html_extract.main_text(html.replace("LONG", long)) == want.replace("LONG", long.strip())


@pytest.mark.parametrize("part", ["<center>|</zz>", "<b><div>|</b>", "<div><i>|</b><hr>", "<article>|</p>", "<li><i>|<li>"])
def test_parsing_is_linear(part):
    open_, close = part.split("|")
    began = time.time()
    html_extract.main_text(open_ * 30_000 + "words" + close * 30_000)
    assert time.time() - began < 10
