import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from panelspark.llm import queries
from panelspark.llm.pretokens import tokenizer_of
from tests.llm.test_decontaminate import brute as brute_contamination
from tests.llm.test_near_duplicates import brute as brute_near
from tests.sqlcheck import same_rows


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_matches_sql(spark, sf, name):
    same_rows(spark, sf, queries.queries()[name], queries.oracle_sql()[name])


def test_pipeline_against_brute_force(spark, sf):
    from panelspark.llm.shared import stored

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    steps = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, sf), name)
        assert out.columns == columns
        steps.append((docs.collect(), out.collect()))
        docs = out
    rows = [[(r.doc_id, r.text) for r in side] for step in steps for side in step]
    assert set(rows[1]) < set(rows[0]) and len(rows[1]) > 0.7 * len(rows[0])
    assert sorted(r[0] for r in rows[3]) == sorted(r[0] for r in brute_near(rows[2], 80) if r[3])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert sorted(r[0] for r in rows[5]) == sorted(r[0] for r in brute_contamination(rows[4], items, 10) if not r[5])
    taken = Counter(rows[7])
    assert set(taken) <= set(rows[6]) and max(taken.values()) <= 2
    words = lambda side: sum(len(t.split()) for _, t in side)
    assert abs(words(rows[7]) / words(rows[6]) - 1.5) < 0.05
    got = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    with open(queries.tokenizer_path(queries.TOKENIZER_STORE)) as f:
        t = tokenizer_of(f.read())
    want = Counter((d, zlib.crc32(np.array([*e.ids, 2], "<u4").tobytes())) for (d, _), e in zip(rows[7], t.encode_batch([x for _, x in rows[7]], add_special_tokens=False), strict=True))
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == want
