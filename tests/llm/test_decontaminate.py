import hashlib
import random
import re
import time

import pyarrow as pa
from pyspark.sql import functions as F

from panelspark.llm import decontaminate
from tests.llm import edge
from tests.llm.test_lines_and_chat import FOLD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall((t or "").translate(FOLD))


def brute(rows, items, window):
    windows = {}
    for i, t in items:
        w = words(t)
        k = min(window, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[j : j + k]), set()).add(str(i) if i is not None else "null")
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if s := windows.get(tuple(w[j : j + k])):
                    found |= s
                    hit |= set(range(j, j + k))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(1, "beta GAMMA, delta"), (2, "one"), (None, "文字 word"), (3, None), (4, ""), (5, "!!"), (10, "wort5 zeile5 wort6 zeile6 wort7 zeile7 wort8 zeile8 wort9 zeile9 wort10 zeile10 wort11"), (6, "tail"), (1, "alpha beta")]


def test_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").unionByName(edge.docs(spark, False).select("doc_id", "text"))
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").unionByName(spark.createDataFrame(ITEMS, "item_id long, text string"))
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()], 10)
    for block in (1 << 25, 2000):
        got = decontaminate.contamination(docs.withColumn("n_hit", F.lit("x")), bench, block_bytes=block).collect()
        assert sorted((tuple(r)[:6] for r in got), key=str) == want
    clean = [w for w in brute([(r[0], r[1]) for r in edge.ROWS], [(r.item_id, r.text) for r in bench.collect()], 10) if not w[5]]
    for block in (1 << 25, 2000):
        kept = decontaminate.decontaminated(edge.docs(spark), bench, block_bytes=block)
        assert kept.columns == edge.docs(spark).columns
        assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((w[0] for w in clean), key=str)


def test_longest_matches(spark):
    docs = spark.createDataFrame([(1, "a b c d e f x y"), (2, "q a b c q d e f g h"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "z a b c d e f g h")], "item_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.longest_matches(docs, bench, least=3).collect())
    assert got == [(1, "7", 0, 6), (2, "7", 5, 5)]
    got = sorted(tuple(r)[:1] + tuple(r)[6:] for r in decontaminate.contamination(docs, bench, window=3).collect())
    assert got == [(1, 6, "7", 0), (2, 5, "7", 5), (3, 0, None, None)]


def longest_shared(doc, items):
    """Words, first word and least item of the longest run of words that a document shares with any item."""
    best = (0, None, None)
    for at in range(len(doc)):
        for name, w in items:
            for j in range(len(w)):
                n = 0
                while at + n < len(doc) and j + n < len(w) and doc[at + n] == w[j + n]:
                    n += 1
                if n and (-n, at, name) < (-best[0], best[1] if best[1] is not None else at + 1, best[2] or ""):
                    best = (n, at, name)
    return best


def test_longest_matches_against_brute_force(spark):
    rng = random.Random(3)
    docs = [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(30))) for _ in range(60)]
    docs += ["a b c d e f"] * 3 + ["a " * 50, "x y z", ""]
    items = [(str(i), " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 14)))) for i in range(12)] + [("9a", "a " * 20), ("9b", "a " * 20)]
    want = [(i, *longest_shared(words(t), [(n, words(x)) for n, x in items])) for i, t in enumerate(docs)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    hits = brute(list(enumerate(docs)), items, 3)
    # the same with any cut into shards and blocks
    for parts, shard, block in ((1, 1 << 22, 1 << 25), (5, 1 << 22, 60), (2, 40, 1 << 25)):
        old, decontaminate.SHARD = decontaminate.SHARD, shard
        try:
            got = decontaminate.contamination(df.repartition(parts), bench, window=3, block_bytes=block).collect()
        finally:
            decontaminate.SHARD = old
        assert sorted(tuple(r)[:6] for r in got) == sorted(hits)
        assert sorted((r.doc_id, r.longest, r.longest_at, r.longest_item) for r in got) == want


def test_longest_of_each_item():
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(40))) for _ in range(20)]
    items = [(str(i), " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 12)))) for i in range(12)]
    test = decontaminate.TestSuffixes([i for i, _ in items], [t for _, t in items], 3)
    for t in texts:
        got = {test.names[i]: (n, at) for i, at, n in decontaminate.longest_of_items(pa.array([t]), test).tolist() if n}
        want = {i: longest_shared(t.split(), [(i, x.split())])[:2] for i, x in items}
        assert got == {i: w for i, w in want.items() if w[0]}


def test_repetitive_text_takes_little_time():
    began = time.time()
    test = decontaminate.TestSuffixes(["1"], ["the " * 400], 10)
    m = decontaminate.Matches(pa.array(["the " * 100_000]), test)
    assert m.hit.all() and m.best.tolist() == [[0, 0, 400, 0]]
    assert time.time() - began < 3
    began = time.time()
    test = decontaminate.TestSuffixes([str(i) for i in range(2000)], ["the"] * 2000, 10)
    m = decontaminate.Matches(pa.array(["the x " * 50_000, "the " * 50_000]), test)
    rows, names = m.items(test)
    assert [len(names[k]) for k in rows] == [2000, 2000] and m.hits().tolist() == [50_000, 50_000]
    assert time.time() - began < 4


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(edge.docs(spark), none).filter("contaminated").count() == 0
    assert decontaminate.contamination(edge.empty(spark), none).count() == 0
