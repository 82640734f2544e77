import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark.llm import token_counts, token_store
from panelspark.llm.pretokens import tokenizer_of
from panelspark.llm.queries import tokenizer_path
from panelspark.llm.shared import new_path
from tests.llm import edge

ODD = ["a  b", "a\n\nb", " x", " ", "\n", "  ", "a \n b", " a \n\nb", "foo  <|endoftext|>  bar", "don't  we'll \t x", "é ü\n \n", "...  !!\r\n\r\nx 12 34", "İstanbul ΣΑΣ ﬁ Ⅷ", "a　　 b\u0085\nc", "WE'LL x1y22 <|startoftext|>", "tab\t\tend \t"]


def _docs(spark, sf):
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    return edge.docs(spark, False).select("doc_id", "text").unionByName(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")).unionByName(odd)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_are_the_library_s(spark, sf, name):
    df = _docs(spark, sf)
    with open(tokenizer_path(name)) as f:
        t = tokenizer_of(f.read())
    rows = df.collect()
    want = sorted(((r.doc_id, len((r.text or "").encode()), len(e.ids), len(e.ids) > 1024) for r, e in zip(rows, t.encode_batch([r.text or "" for r in rows], add_special_tokens=False), strict=True)), key=str)
    got = token_counts.token_counts(df, tokenizer_path(name)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got), key=str) == want


def test_counts_keep_columns_and_empty_tables(spark):
    out = token_counts.token_counts(edge.docs(spark).withColumn("n_tokens", F.lit("old")), tokenizer_path("byte_bpe_50k.json"))
    assert {"lang", "bucket", "n_tokens"} <= set(out.columns) and out.schema["n_tokens"].dataType.simpleString() == "bigint"
    assert token_counts.token_counts(edge.empty(spark), tokenizer_path("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_store_round_trip(spark, sf, name, monkeypatch):
    df = _docs(spark, sf)
    path = new_path(spark, "t")
    monkeypatch.setattr(token_store, "BLOCK_IDS", 5000)
    token_store.write_tokens(df, path, tokenizer_path(name), end_id=2)
    with open(tokenizer_path(name)) as f:
        t = tokenizer_of(f.read())
    rows = df.collect()
    ids = [[*e.ids, 2] for e in t.encode_batch([r.text or "" for r in rows], add_special_tokens=False)]
    want = sorted(((r.doc_id, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for r, i in zip(rows, ids, strict=True)), key=str)
    got = token_store.read_digests(spark, path).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == want
    at = 0
    last = -1
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (r.doc_id is None or r.doc_id >= last)
        at, last = at + r.n_tokens, r.doc_id if r.doc_id is not None else last
    for d in (1000, 12, 11):
        assert sorted(token_store.read_one(spark, path, d)) == sorted(i for r, i in zip(rows, ids, strict=True) if r.doc_id == d)
    assert token_store.read_one(spark, path, 99999) == []


def test_store_of_an_empty_table(spark):
    path = new_path(spark, "t")
    token_store.write_tokens(edge.empty(spark), path, tokenizer_path("word_bpe_49k.json"), end_id=2)
    assert token_store.read_digests(spark, path).count() == 0
