import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from panelspark.llm import embedding_dedup, minhash, sketch
from panelspark.llm.components import components
from tests.llm import edge
from tests.llm.test_lines_and_chat import FOLD


def closure(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingle_set(t, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, percent):
    sets = [(i, shingle_set(t)) for i, t in rows]
    links = []
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b and i != j:
                x = len(a & b)
                if 100 * x >= percent * (len(a) + len(b) - x):
                    links.append((i, j))
    comp = closure({i for i, _ in rows if i is not None}, links)
    return sorted(((i, len(s), comp.get(i), i is None or comp[i] == i) for i, s in sets), key=str)


def test_minhash_against_brute_force(spark, sf):
    rng = random.Random(5)
    base = [f"w{rng.randrange(4000)}" for _ in range(120)]
    rows = [(10_000 + n, " ".join(w if rng.random() > rng.choice([0.003, 0.01, 0.016, 0.03]) else f"v{rng.random()}" for w in base)) for n in range(400)]
    rows += [(20_000 + n, "exact copy of a short text with nine words") for n in range(300)]
    rows += [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + [(r[0], r[1]) for r in edge.ROWS]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rep": F.lit(1), "n": F.lit(2), "k1": F.lit(3)})
    for percent in (85, 80):
        got = sorted((tuple(r) for r in minhash.near_duplicates(df, percent=percent).collect()), key=str)
        assert got == brute(rows, percent)


def test_minhash_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(6)
    base = [f"w{n}" for n in range(100)]
    rows = [(n, " ".join(w if rng.random() > 0.015 else f"v{rng.random()}" for w in base)) for n in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in minhash.near_duplicates(df, percent=85).collect()), key=str) == brute(rows, 85)
    kept = minhash.near_deduplicated(edge.docs(spark))
    assert kept.columns == edge.docs(spark).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r[0] for r in brute([(r[0], r[1]) for r in edge.ROWS], 80) if r[3]), key=str)


def test_empty_tables(spark):
    assert minhash.near_duplicates(edge.empty(spark)).count() == 0
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 400, dtype=np.uint64)
    for share in (0.5, 0.8, 0.95):
        n = int(400 * 2 * share / (1 + share))
        b = np.concatenate([a[:n], rng.integers(0, 2**63, 400 - n, dtype=np.uint64)])
        s = sketch.sketch(np.concatenate([a, b, a[:3]]), np.array([0, 400, 800, 803, 803]), 512)
        assert abs((s[0] == s[1]).mean() - n / (800 - n)) < 0.08
        assert (s[2] != np.iinfo(np.uint64).max).all() and not s[3].any()
    assert sketch.bands_for(0.85, 4, 1e-7) * 4 <= 96


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = closure({x for e in links for x in e if e[0] != e[1]}, links)
    assert got == want


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    monkeypatch.setattr(embedding_dedup, "BOXES", 3)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    x = [(centres[i % 12] + rng.normal(size=16) * rng.choice([0.05, 0.3, 1.0])).tolist() for i in range(500)]
    rows = [(i, v) for i, v in enumerate(x)] + [(600, x[3]), (601, x[3]), (602, [2 * c for c in x[4]]), (603, None), (604, []), (605, [0.0] * 16), (606, [float("nan")] * 16), (607, [None] + [1.0] * 15), (608, [float("inf")] * 16), (609, [1.0, 2.0]), (None, x[5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"label": F.lit(0), "id": F.lit(1), "rep": F.lit(2)})
    fine = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v) and len(v) == 16]
    links = [(i, j) for n, (i, a) in enumerate(fine) for j, b in fine[:n] if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9]
    comp = closure([i for i, _ in rows if i is not None], links)
    n = {i: 0 for i in comp}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(df).collect()}
    assert got == {i: (n[i], comp[i], comp[i] == i) for i in comp} | {None: (0, None, True)}


def test_vectors_of_any_magnitude(spark):
    rows = [(1, [1e-170, 0.0]), (2, [1e-170, 0.0]), (3, [1e200, 1e200]), (4, [1e200, 1e200]), (5, [3e-180, 3e-180]), (6, [5.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 6: (2, 1), 3: (2, 3), 4: (2, 3), 5: (2, 3)}


def test_unequal_copies_in_one_cell(spark):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=24)
    rows = [(i, (centre + rng.normal(size=24) * 0.02).tolist()) for i in range(3000)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.filter("n_links = 2999 AND component_id = 0").count() == 3000


def test_shared_folder_must_be_set_on_a_cluster(spark):
    from types import SimpleNamespace

    import pytest

    from panelspark.llm.shared import shared_folder

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        shared_folder(cluster)


def test_ids_that_are_no_numbers(spark):
    rows = [("b", "one two three four five six"), ("a", "one two three four five six"), ("c", "quite another text of six words"), ("Z", None), (None, "x y"), ("b", "one two three four five six")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([("b", 2, "a", False), ("a", 2, "a", True), ("c", 2, "c", True), ("Z", 0, "Z", True), (None, 1, None, True), ("b", 2, "a", False)], key=str)
    assert sorted((r.doc_id or "" for r in minhash.near_deduplicated(df).collect())) == ["", "Z", "a", "c"]
    vectors = spark.createDataFrame([("y", [1.0, 0.0]), ("x", [2.0, 0.1]), ("w", [0.0, 1.0]), (None, [1.0, 0.0])], "vec_id string, embedding array<double>")
    got = sorted((tuple(r) for r in embedding_dedup.near_vectors(vectors).collect()), key=str)
    assert got == sorted([("y", 1, "x", False), ("x", 1, "x", True), ("w", 0, "w", True), (None, 0, None, True)], key=str)


def test_wide_vectors_make_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_BYTES", 8 * 16 * 10)
    rng = np.random.default_rng(5)
    rows = [(i, (np.eye(16)[i % 5] + 0.01 * rng.normal(size=16)).tolist()) for i in range(90)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {i: (17, i % 5) for i in range(90)}
