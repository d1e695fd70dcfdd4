"""From raw documents to packed training sequences, one operator a stage.

Every stage takes all rows that its predecessor kept. `run` writes each
stage's rows to the shared folder and reads them back, so a lost executor
costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattline.llm import ngram_join, packing, quality, suffix_dedup, toxicity
from wattline.llm.common import save, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the current policy go."""
    return quality.apply_policy(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return ngram_join.one_of_each_group(docs)


def suffix_array_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a 200-byte string that starts anywhere else go."""
    return suffix_dedup.remove_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens get their places in sequences."""
    return packing.packed(spark, docs, added_tokens=True)


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", ngram_join_stage),
    ("suffix-array dedup", suffix_array_stage),
    ("best-fit packing", packing_stage),
]

# A trained classifier, tokens and a packing are beyond SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir))
    return docs
