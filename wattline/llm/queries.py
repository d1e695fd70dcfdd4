"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattline.llm import (
    bpe, chat, filter_audit, langid, merkle, neighbours, ngram_join, packing, quality, sharding, span_dedup, suffix_dedup, toxicity)
from wattline.llm.common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return span_dedup.without_repeats(documents, both_ends=True)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(table(spark, sf_dir, "documents"))


def op3_approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.conversations(chat.with_hostile(spark, table(spark, sf_dir, "conversations"))))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(spark, table(spark, sf_dir, "documents"), added_tokens=True)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_approximate_neighbours": op3_approximate_neighbours,
    "op4_bpe": op4_bpe,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_sharding": op6_sharding,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_language_id": op13_language_id,
}

ORACLE = {
    "op8_quality_rules": quality.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}
