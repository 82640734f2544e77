"""Token ids in files: each document is compressed by itself with a zstandard dictionary that all share.

File format, in a folder:
* ``dictionary``: one row (dict_hash, dictionary, id_bytes, end_id). The dictionary is trained on the serialized ids of
  about ``TRAIN_DOCS`` documents, none longer than ``TRAIN_BYTES`` of text, those whose hash of id and text is under a bound
  set by their number; it changes the size of frames and nothing else. Too few to train on: an empty dictionary.
* ``blocks``: rows (part, block, dict_hash, doc_ids, n_tokens, offsets, frames). ``frames`` holds the zstandard frames of
  consecutive documents, that of document i from offsets[i] to offsets[i + 1]; a frame has the ids as little-endian
  unsigned numbers of ``id_bytes`` bytes. (part, block) is the order of blocks, ascending by doc_id (null first).
Blocks are written by Spark's Parquet writer, so a lost task or executor leaves no half-written file, and any file system
that Spark knows will do. ``read_one`` decompresses one document of one block.

Ids come from the tokenizers library; pieces between white space are encoded once and kept in a cache of the worker
(see pretokens). Definitions whose pieces could depend on white space are encoded text by text.

Defined results: null is an empty text (the end id only); rows with the same doc_id are ordered by a hash of their text;
an empty table gives a folder without blocks; other columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrowtext import NOT_SPACE, buffers, slices, words
from .pretokens import PieceCache, PieceEncoder, distinct, tokenizer_of
from .shared import checked, hash_share, tidy

TRAIN_DOCS, TRAIN_BYTES, DICTIONARY_BYTES = 400, 50_000, 32_768
BLOCK_IDS = 2_000_000
#: Starts of blocks are broadcast up to so many; beyond it, blocks are joined to them by a shuffle.
BROADCAST_BLOCKS = 1_000_000
_WORKER: dict = {}


def _pieces_hold(definition: str) -> bool:
    """Whether white space separates pre-tokens and is dropped, so that pieces between it are encoded independently."""
    pre = json.loads(definition).get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [{}])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    return first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert")) and " ?" not in pattern and "\\s+" not in pattern


def _folds(definition: str) -> bool:
    n = json.loads(definition).get("normalizer") or {}
    return {x.get("type") for x in n.get("normalizers", [n])} == {"NFC", "Replace", "Lowercase"}


def encode_batch(column: pa.Array, definition: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows, one row after another, and the offset of each row."""
    key = hash(definition)
    if key not in _WORKER:
        encoder = PieceEncoder(definition, fold=True)
        _WORKER[key] = (encoder.tokenizer, PieceCache(encoder), _pieces_hold(definition) and _folds(definition))
    tokenizer, cache, pieces_hold = _WORKER[key]
    if not pieces_hold:
        got = [e.ids for e in tokenizer.encode_batch_fast([x or "" for x in column.to_pylist()], add_special_tokens=False)]
        return np.array([i for x in got for i in x], np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int64)
    raw, offsets = buffers(column)
    w = words(raw, offsets, NOT_SPACE)
    if not len(w.start):
        return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
    first, inverse = distinct(raw, w)
    data = raw.tobytes()
    kinds = cache.get([data[a:b] for a, b in zip(w.start[first], w.end[first], strict=True)])
    size = np.fromiter(map(len, kinds), np.int64, len(kinds)) >> 2
    flat, at = np.frombuffer(b"".join(kinds), "<u4"), np.cumsum(size) - size
    n = size[inverse]
    total = np.concatenate([[0], np.cumsum(n)])
    ids = flat[np.repeat(at[inverse] - total[:-1], n) + np.arange(total[-1])]
    return ids, total[w.first]


def _train(docs: DataFrame, id_col: str, text_col: str, definition: str, end_id: int, id_bytes: int) -> bytes:
    drawn = hash_share(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), TRAIN_DOCS, docs.count())
    rows = docs.filter(drawn & F.octet_length(f"`{text_col}`").between(1, TRAIN_BYTES)).select(F.col(f"`{text_col}`").alias("t")).limit(2 * TRAIN_DOCS).collect()
    tokenizer = tokenizer_of(definition)
    samples = [np.array([*e.ids, end_id], f"<u{id_bytes}").tobytes() for e in tokenizer.encode_batch_fast([r.t for r in rows], add_special_tokens=False)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=1, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor(level=1)


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id`` and write the files in ascending order of ids. tokenizer: path of a .json file."""
    spark: SparkSession = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        definition = f.read()
    id_bytes = 2 if max(tokenizer_of(definition).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    source = checked(docs, id_col, text_col)
    dictionary = _train(source, id_col, text_col, definition, end_id, id_bytes)
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(dict_hash, bytearray(dictionary), id_bytes, end_id)], "dict_hash string, dictionary binary, id_bytes int, end_id long").coalesce(1).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast((definition, dictionary))
    id_type = source.schema[id_col].dataType.simpleString()
    schema = f"part int, block int, dict_hash string, doc_ids array<{id_type}>, n_tokens array<bigint>, offsets array<bigint>, frames binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        definition, dictionary = shared.value
        press = _compressor(dictionary)
        part, block = TaskContext.get().partitionId(), 0
        ids, counts, frames, held = [], [], [], 0

        def out():
            sizes = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype(np.int64)
            id_array = pa.concat_arrays(ids)
            n = len(id_array)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([dict_hash]),
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), id_array),
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array(np.concatenate(counts).astype(np.int64))),
                    pa.ListArray.from_arrays(pa.array([0, n + 1], pa.int32()), pa.array(sizes)),
                    pa.array([b"".join(frames)], pa.binary()),
                ],
                names=["part", "block", "dict_hash", "doc_ids", "n_tokens", "offsets", "frames"],
            )

        for batch in batches:
            for piece in slices(batch, 1):
                flat, at = encode_batch(piece.column(1), definition)
                ids.append(piece.column(0))
                counts.append(np.diff(at) + 1)
                for a, b in zip(at[:-1], at[1:], strict=True):
                    frames.append(press.compress(np.append(flat[a:b], np.uint32(end_id)).astype(f"<u{id_bytes}").tobytes()))
                held += len(flat) + len(at) - 1
                if held >= BLOCK_IDS:
                    yield out()
                    block += 1
                    ids, counts, frames, held = [], [], [], 0
        if ids:
            yield out()

    ordered = source.withColumn("_tie", F.xxhash64(f"`{text_col}`")).repartitionByRange(F.col(f"`{id_col}`").asc_nulls_first(), "_tie").sortWithinPartitions(F.col(f"`{id_col}`").asc_nulls_first(), "_tie")
    ordered.select(id_col, text_col).mapInArrow(tidy(run), schema).write.option("compression", "none").parquet(f"{path}/blocks")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes, int]:
    r = spark.read.parquet(f"{path}/dictionary").first()
    data = bytes(r.dictionary)
    if hashlib.sha256(data).hexdigest() != r.dict_hash:
        raise ValueError(f"the dictionary in {path} is not the one that its hash names")
    return r.dict_hash, data, r.id_bytes


def read_digests(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """From the files: id, start (ids of all documents before), n_tokens, ids_crc32 of the ids as 4-byte little-endian numbers."""
    blocks = spark.read.parquet(f"{path}/blocks")
    # blocks are few and parts fewer: a part is a task of the writer
    totals = blocks.select("part", "block", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = totals.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    starts = totals.join(parts, "part").select("part", "block", (F.col("before") + F.sum("n").over(Window.partitionBy("part").orderBy("block")) - F.col("n")).alias("start"))
    dict_hash, dictionary, id_bytes = _dictionary(spark, path)
    shared = spark.sparkContext.broadcast(dictionary)
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"`{id_col}` {id_type}, start long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = _decompressor(shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name, i=i, batch=batch: batch.column(batch.schema.get_field_index(name))[i]
                if get("dict_hash").as_py() != dict_hash:
                    raise ValueError("a block was written with another dictionary")
                at, frames = get("offsets").values.to_numpy(), get("frames").as_py()
                n, crc = [], []
                for a, b in zip(at[:-1], at[1:], strict=True):
                    ids = np.frombuffer(press.decompress(frames[a:b]), f"<u{id_bytes}").astype("<u4")
                    n.append(len(ids))
                    crc.append(zlib.crc32(ids.tobytes()))
                before = get("start").as_py() + np.cumsum(n) - n
                yield pa.RecordBatch.from_arrays([get("doc_ids").values, pa.array(before, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], names=[id_col, "start", "n_tokens", "ids_crc32"])

    # a row for each block, so blocks themselves need not move
    starts = F.broadcast(starts) if totals.count() <= BROADCAST_BLOCKS else starts
    return blocks.join(starts, ["part", "block"]).select("dict_hash", "doc_ids", "offsets", "frames", "start").mapInArrow(tidy(run), schema)


def read_one(spark: SparkSession, path: str, doc_id) -> list[list[int]]:
    """The ids of each row with this doc_id, through the offset index; only its frame is decompressed."""
    _, dictionary, id_bytes = _dictionary(spark, path)
    rows = (
        spark.read.parquet(f"{path}/blocks")
        .filter(F.array_contains("doc_ids", F.lit(doc_id)))
        .select("part", "block", F.explode(F.filter(F.sequence(F.lit(0), F.size("doc_ids") - 1), lambda i: F.get("doc_ids", i) == doc_id)).alias("i"), "offsets", "frames")
        .select("part", "block", "i", F.substring("frames", (F.get("offsets", F.col("i")) + 1).cast("int"), (F.get("offsets", F.col("i") + 1) - F.get("offsets", F.col("i"))).cast("int")).alias("frame"))
        .orderBy("part", "block", "i")
        .collect()
    )
    press = _decompressor(dictionary)
    return [np.frombuffer(press.decompress(bytes(r.frame)), f"<u{id_bytes}").tolist() for r in rows]
