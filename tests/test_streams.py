import random

import pytest
from pyspark.sql import functions as F

from panelspark.operators import batches


def brute(sizes, limit, most):
    batch, used, n, out = -1, 0, most, []
    for s in sizes:
        if n >= most or used + s > limit:
            batch, used, n = batch + 1, 0, 0
        used, n = used + s, n + 1
        out.append(batch)
    return out


@pytest.mark.parametrize("limit,most,kind", [(100, 5, "small"), (100, 50, "zeros"), (30, 3, "large"), (10**9, 7, "small"), (1, 1, "zeros")])
def test_batches_over_one_stream(spark, limit, most, kind):
    rng = random.Random(limit + most)
    sizes = [{"small": rng.randrange(40), "zeros": rng.choice([0, 0, 0, 60]), "large": rng.choice([1, 29, 31, 500])}[kind] for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(sizes)), "i long, s long").repartition(7)
    got = [r.batch for r in sorted(batches.batched(df, ["i"], "s", limit, most, block=64).collect(), key=lambda r: r.i)]
    assert got == brute(sizes, limit, most)


@pytest.mark.parametrize("n", [150, 330, 513])
def test_the_end_of_the_stream_is_no_entry_of_its_last_block(spark, n):
    sizes = [i * 37 % 90 for i in range(n)]
    df = spark.createDataFrame(list(enumerate(sizes)), "i long, s long").repartition(3)
    got = [r.batch for r in sorted(batches.batched(df, ["i"], "s", 100, 4, block=64).collect(), key=lambda r: r.i)]
    assert got == brute(sizes, 100, 4)


def test_batches_of_few_and_odd_rows(spark):
    none = spark.createDataFrame([], "i long, s long")
    assert batches.batched(none, ["i"], "s", 10, 3).count() == 0
    rows = spark.createDataFrame([(1, None, "x"), (2, -5, "y"), (3, 11, "z"), (4, 1, None)], "i long, s long, batch_name string")
    assert [(r.i, r.batch, r.batch_name) for r in sorted(batches.batched(rows, ["i"], "s", 10, 3).collect())] == [(1, 0, "x"), (2, 0, "y"), (3, 1, "z"), (4, 2, None)]


def test_rows_are_numbered_in_order(spark):
    df = spark.range(1000).withColumn("s", F.lit(3).cast("long"))
    assert batches.numbered(df.repartition(5), ["id"]).filter("position <> id").count() == 0


def test_null_keys_stand_last(spark):
    rows = spark.createDataFrame([(None, 5), (3, 6), (1, 6)], "i long, s long")
    assert {(r.i, r.batch) for r in batches.batched(rows, ["i"], "s", 11, 3).collect()} == {(1, 0), (3, 1), (None, 1)}
