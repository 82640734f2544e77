import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import hard_negatives as hn


def brute(rows, anchor, positives=5, negatives=5, low=80, high=100):
    fine = [(i, y, [math.floor(256 * c) for c in x]) for i, y, x in rows if i is not None and y is not None and x and all(c is not None and math.isfinite(c) for c in x)]
    out = set()
    for a, y, x in fine:
        if not anchor(a):
            continue
        scores = sorted(((-sum(p * q for p, q in zip(x, v, strict=True)), b, z == y) for b, z, v in fine if len(v) == len(x)))
        for s, p, _ in [e for e in scores if e[2] and e[1] != a][:positives]:
            window = [e for e in scores if not e[2] and low * -s <= 100 * -e[0] <= high * -s][:negatives]
            out |= {(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(window)}
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 40)
    monkeypatch.setattr(hn, "ANCHORS", 3)
    monkeypatch.setattr(hn, "ANCHOR_BYTES", 8 * 16 * 7)


def vectors(rng, n, d, kind):
    x = rng.normal(size=(n, d))
    if kind == "clusters":
        x = rng.normal(size=(6, d))[rng.integers(0, 6, n)] + 0.2 * x
    if kind == "heavy first":
        x *= np.linspace(2, 0.05, d)
    if kind == "negative":
        x = -np.abs(x)
        x[: n // 2] *= -1
    if kind == "ties":
        x = rng.integers(-1, 2, (n, d)) / 256.0
    return x.round(3).tolist()


@pytest.mark.parametrize("kind", ["round", "clusters", "heavy first", "negative", "ties"])
def test_against_brute_force(spark, small, kind):
    rng = np.random.default_rng(len(kind))
    x = vectors(rng, 500, 16, kind)
    rows = [(i, int(rng.integers(0, 4)), v) for i, v in enumerate(x)] + [(900, 7, x[3]), (901, 7, x[3])]
    got = [tuple(r) for r in hn.hard_negatives(table(spark, rows), F.col("vec_id") % 25 == 0).collect()]
    assert set(got) == brute(rows, lambda i: i % 25 == 0) and len(got) == len(set(got))
    other = [tuple(r) for r in hn.hard_negatives(table(spark, rows), F.col("vec_id") % 50 == 0, 2, 9, 30, 120).collect()]
    assert set(other) == brute(rows, lambda i: i % 50 == 0, 2, 9, 30, 120)


def test_a_vector_that_a_third_repeats(spark, small):
    rng = np.random.default_rng(9)
    x = [[0.5] * 12] * 200 + vectors(rng, 300, 12, "clusters")
    rows = [(i, int(i % 3), v) for i, v in enumerate(x)]
    assert {tuple(r) for r in hn.hard_negatives(table(spark, rows), F.col("vec_id") % 20 == 0).collect()} == brute(rows, lambda i: i % 20 == 0)


def test_rows_that_take_no_part(spark):
    rows = [(0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.5]), (2, 2, [0.9, 0.5]), (3, 2, [1.0, None]), (4, 2, None), (5, None, [1.0, 1.0]), (6, 2, [float("nan"), 1.0]), (7, 2, [float("inf"), 1.0]), (None, 2, [1.0, 0.6]), (8, 2, []), (9, 2, [1.0, 0.5, 2.0]), (100, 3, [1.0, 1.0])]
    df = table(spark, rows).withColumns({c: F.lit(1) for c in ("id", "x", "anchor", "score", "slot", "_anchor")})
    got = {tuple(r) for r in hn.hard_negatives(df, F.col("vec_id") % 100 == 0).collect()}
    assert got == brute(rows, lambda i: i % 100 == 0) and {r[0] for r in got} == {0}
    assert hn.hard_negatives(table(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    assert hn.hard_negatives(table(spark, rows), F.lit(None).cast("boolean")).count() == 0


def test_components_of_any_size(spark):
    rows = [(0, 1, [1e300, 1.0]), (1, 1, [1e300, 2.0]), (2, 2, [1e299, 1.0]), (3, 2, [-1e300, 0.0])]
    assert hn.hard_negatives(table(spark, rows), F.col("vec_id") == 0).count() <= 5


def test_suffix_norms_leave_dimensions_out():
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(size=(300, 32)) * np.linspace(2, 0.01, 32))
    block = hn.Block(np.arange(300), np.zeros(300, np.int64), x)
    anchors = block.part(slice(0, 5))
    join = hn.Join(anchors, block, np.ones((5, 300), bool))
    truth = anchors.x @ x.T
    for level in (0.8, 0.5, 0.2):
        thresholds = level * truth.max(1)
        join.lower(thresholds)
        complete = {(i, j): s for i, j, s in zip(join.i.tolist(), join.j.tolist(), join.score.tolist(), strict=True)}
        assert all(abs(complete[p] - truth[p]) < 1e-6 for p in complete)
        assert {(i, j) for i, j in zip(*np.nonzero(truth >= thresholds[:, None]), strict=True)} <= set(complete)
        assert level < 0.5 or (join.indexed.max() < hn.RUNS and len(complete) < truth.size)
