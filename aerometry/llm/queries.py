"""Registered queries of the operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from aerometry.llm import (
    bpe_automaton,
    conversation_repair,
    decision_list,
    hamming_search,
    minhash,
    packing,
    pii,
    preference,
    ranking,
    secret_scan,
    spelling,
    substring_dedup,
    warc,
)
from aerometry.llm.documents import share_library

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        share_library(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(_table(spark, sf_dir, "documents"))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary)


@query
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), with_links=True)


@query
def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.swapped_pairs(_table(spark, sf_dir, "conversations"))
    return preference.format_preferences(pairs)


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return bpe_automaton.encode_documents(_table(spark, sf_dir, "documents"), vocabulary)


@query
def op8_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_search.nearest(_table(spark, sf_dir, "embeddings"))


@query
def op9_pairwise_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return ranking.score_quality(documents, labels)


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return decision_list.apply_quality_rules(documents, labels)


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(_table(spark, sf_dir, "conversations"))


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_table(spark, sf_dir, "pages"))
