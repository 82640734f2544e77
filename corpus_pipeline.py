"""The corpus pipeline: from documents to files of token ids, each stage one operator of the training-data package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspark.llm.decontaminate import decontaminated
from panelspark.llm.minhash import near_deduplicated
from panelspark.llm.mixing import mixed
from panelspark.llm.quality import good_documents
from panelspark.llm.queries import TOKENIZER_STORE, tokenizer_path
from panelspark.llm.shared import new_path, stored
from panelspark.llm.token_store import read_digests, write_tokens


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of documents among these."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (word 5-shingles, similarity of 0.8 or more), the one with the least id."""
    return near_deduplicated(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: weights 5, 2, 1 in turn, 150% of all words, no source above 2 times."""
    return mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written to files and read back: doc_id, start, n_tokens, ids_crc32."""
    path = new_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_path(TOKENIZER_STORE), end_id=2)
    return read_digests(spark, path)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing), ("token_files", token_files)]

#: The classifier and the tokenizer have no SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
