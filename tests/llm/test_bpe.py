import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelspark.llm import bpe, queries
from panelspark.llm.pretokens import tokenizer_of
from panelspark.llm.queries import tokenizer_path
from tests.llm import edge
from tests.llm.test_tokens import ODD, _docs

NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def library(name):
    with open(tokenizer_path(name), encoding="utf-8") as f:
        definition = f.read()
    return definition, tokenizer_of(definition)


@pytest.mark.parametrize("name", NAMES)
def test_ids_and_texts_are_the_library_s(spark, sf, name):
    df = _docs(spark, sf)
    _, t = library(name)
    rows = df.collect()
    ids = [e.ids for e in t.encode_batch([r.text or "" for r in rows], add_special_tokens=False)]
    want = sorted(((r.doc_id, i, t.decode(i, skip_special_tokens=False)) for r, i in zip(rows, ids, strict=True)), key=str)
    got = bpe.bpe_decoded(bpe.bpe_encoded(df, tokenizer_path(name)), tokenizer_path(name)).collect()
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got), key=str) == want
    got = bpe.bpe_encoded(df, tokenizer_path(name), decoded_col="decoded").collect()
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got), key=str) == want


@pytest.mark.parametrize("name", NAMES)
def test_characters_and_long_words(name, monkeypatch):
    definition, t = library(name)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x600 or c % 61 == 0)]
    texts = ["a" + chr(c) + "b " + chr(c) + " Z" + chr(c) + chr(c) for c in points] + ODD + ["x" * 3000 + "y", "ab" * 30, "aé" * 400, "na" * 25 + "." * 60]
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    for short in (48, 4):
        monkeypatch.setattr(bpe, "SHORT", short)
        ids, ends = bpe.Encoder(definition)(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == want


def test_merges_take_the_least_rank_and_the_first_of_equals():
    rng = random.Random(2)
    letters = bpe.byte_letters()
    vocab = {letters[b]: b for b in range(256)}
    merges = []
    while len(merges) < 60:
        a, b = rng.choice([*"abcd", *[x + y for x, y in merges]]), rng.choice([*"abcd", *[x + y for x, y in merges]])
        if a + b not in vocab and len(a + b) < 9:
            vocab[a + b] = len(vocab)
            merges.append((a, b))
    m = bpe.Merges({"vocab": vocab, "merges": merges})
    rank = {p: i for i, p in enumerate(merges)}

    def slow(word):
        parts = list(word)
        while True:
            best = min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in rank), default=None)
            if best is None:
                return [vocab[p] for p in parts]
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    data = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 90))) for _ in range(400)] + [""]
    assert [x.tolist() for x in m.encode([w.encode() for w in data])] == [slow(w) for w in data]


def test_unknown_ids_null_ids_and_broken_bytes(spark):
    rows = spark.createDataFrame([(1, [0, 10**6, -4, 320]), (2, None), (3, []), (4, [0])], "k long, ids array<int>")
    got = {r.k: r.decoded for r in bpe.bpe_decoded(rows, tokenizer_path(NAMES[0])).collect()}
    _, t = library(NAMES[0])
    assert got == {1: t.decode([0, 320], skip_special_tokens=False), 2: "", 3: "", 4: "!"}
    definition, t = library(NAMES[1])
    ids = [i for i in t.encode("文字 😀").ids][:-1]
    assert bpe.Decoder(definition)(pa.array([ids, None], pa.list_(pa.int32()))).to_pylist() == [t.decode(ids, skip_special_tokens=False), ""]


def test_columns_and_empty_tables(spark):
    docs = edge.docs(spark).withColumn("ids", F.lit("old"))
    out = bpe.bpe_encoded(docs, tokenizer_path(NAMES[0]))
    assert set(out.columns) == set(docs.columns) - {"text"} and out.schema["ids"].dataType.simpleString() == "array<int>" and out.count() == len(edge.ROWS)
    assert bpe.bpe_decoded(bpe.bpe_encoded(edge.empty(spark), tokenizer_path(NAMES[0])), tokenizer_path(NAMES[0])).count() == 0


def test_query(spark, sf):
    _, t = library(queries.TOKENIZER_STORE)
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.add((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    got = queries.op11_bpe(spark, sf)
    assert {tuple(r) for r in got.collect()} == want and got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert np.array([n for _, n, *_ in want]).sum() > 0
