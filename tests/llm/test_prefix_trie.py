import hashlib
import random
import zlib

from pyspark.sql import functions as F

from panelspark.llm import prefix_trie, queries


def brute(convs):
    """convs: id to list of (role, text)."""
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {p: [] for p in members}
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out, sums = [], {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * len(p[-1][1].split()) if p else 0
        sums[p] = (sum(sums[c][0] for c in children[p]) or 1, saved + sum(sums[c][1] for c in children[p]))
        sha = hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]), *sums[p], sha))
    return sorted(out, key=str)


def built(spark, convs):
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_tries_of_any_depth(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 40)
    rng = random.Random(4)
    for depth in (1, 2, 3, 5, 11, 19):
        convs = {}
        for c in range(300):
            n = rng.choice([1, depth, rng.randrange(1, depth + 1)])
            convs[c - 40] = [("user" if i % 2 == 0 else "assistant", rng.choice(["a", "a b", "a", "a", "c d e"])) for i in range(n)]
        for c in range(300, 400):  # a large group that shares its turns
            convs[c] = [("user", "x y z")] * depth
        got = prefix_trie.prefix_trie(prefix_trie.sequences(built(spark, convs)))
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(convs)


def test_turnless_conversations_and_empty_tables(spark):
    none = spark.createDataFrame([], "conv_id long, turns array<struct<symbol: string, words: bigint>>")
    assert prefix_trie.prefix_trie(none).count() == 0
    some = prefix_trie.sequences(built(spark, {7: [("user", "a b")], 3: [("user", "a b"), ("assistant", "c")]}))
    empty = spark.createDataFrame([(5, []), (1, [])], none.schema)
    want = brute({7: [("user", "a b")], 3: [("user", "a b"), ("assistant", "c")], 5: [], 1: []})
    assert sorted((tuple(r) for r in prefix_trie.prefix_trie(some.unionByName(empty)).collect()), key=str) == want
    assert sorted((tuple(r) for r in prefix_trie.prefix_trie(empty).collect()), key=str) == brute({5: [], 1: []})


def test_nulls_ties_long_texts_and_clashing_names(spark):
    long = "wort " * 50_000
    rows = [(1, None, None, None), (1, 0, "user", long), (2, 0, "user", long), (2, None, "", ""), (None, 0, "user", "x"), (3, 1, "user", "b"), (3, 1, "user", "a"), (3, 1, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("name", "depth", "root", "cut", "conv", "symbols", "x", "turns")})
    got = {(r.conv_id, r.depth): (r.n_convs, r.n_children, r.saved_tokens) for r in prefix_trie.prefix_trie(prefix_trie.sequences(df)).collect()}
    assert got[(1, 2)] == (2, 0, 50_000) and got[(1, 1)] == (2, 1, 50_000) and got[(1, 0)] == (3, 2, 50_000) and got[(3, 3)] == (1, 0, 0) and len(got) == 6


def test_query_against_brute_force(spark, sf):
    own = {}
    for r in sorted(spark.read.parquet(f"{sf}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        own.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        convs[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    assert sorted((tuple(r) for r in queries.op13_prefix_trie(spark, sf).collect()), key=str) == brute(convs)
