"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Every stage takes ``(spark, docs, sf_dir)`` and all rows that the stage before it kept. The first four return
the columns they get; the last one returns the training mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressloom.llm import decontamination, jaccard_join, language_id, mixing, secret_scan
from pressloom.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters and texts that no language holds with a probability of one half."""
    return language_id.accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest key stays."""
    return jaccard_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep all documents, with every secret in a text replaced and the length counted anew."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as taken, with ``shard``, ``position`` in it and ``taken_words``."""
    return mixing.mixed(docs)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontamination", decontaminated),
    ("secrets", secrets_removed),
    ("mixture", mixture),
]

# Models and random draws have no SQL equivalent; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
