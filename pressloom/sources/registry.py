"""The source configuration (one JSON document of policy and sources)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.policy import Policy
from pressloom.schemas import REGISTRY_DEFAULTS, SOURCE_CONFIG


def read_config(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SOURCE_CONFIG).option("multiLine", "true").json(path)


def registry(config: DataFrame) -> DataFrame:
    """One row per configured source in file order, with the defaults filled in."""
    listed = config.select(F.posexplode("sources").alias("source_order", "s")).select("source_order", "s.*")
    filled = listed.fillna({key: value for key, value in REGISTRY_DEFAULTS.items()})
    return filled.withColumnRenamed("id", "source_id")


def enabled_sources(sources: DataFrame) -> DataFrame:
    return sources.filter(F.coalesce("enabled", F.lit(False)))


def read_policy(config: DataFrame) -> Policy:
    """The policy is one small object of the configuration file."""
    row = config.select("policy.*").first()
    return Policy.from_config(row.asDict() if row else {})
