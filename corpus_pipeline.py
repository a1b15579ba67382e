"""From raw documents to packed training windows, stage by stage.

Every stage takes the documents that its predecessor kept, as a table, and all but
the last return documents with the same columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from aerometry.llm import minhash, packing, ranking, secret_scan, substring_dedup
from aerometry.llm.documents import share_library
from aerometry.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking predicts to be good."""
    return ranking.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return minhash.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents have."""
    return substring_dedup.remove_repeats(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced."""
    return secret_scan.redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into windows."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("secrets", secrets),
    ("packing", packed),
]

#: A learned ranking, classes of near-duplicates and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is kept as a table in the shared folder."""
    share_library(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        kept = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(kept)
        docs = spark.read.parquet(kept)
    return docs
