"""Publish log, edition index and read-back comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.functions.package import weekday_label
from pressloom.functions.times import iso_day
from pressloom.operators.ledger import Batch, LedgerTable

PUBLISHED = T.StructType([T.StructField("digest", T.StringType()), T.StructField("publish_date", T.StringType())])
# Parts of a log before they are folded into one.
FOLD_AT = 64


def publish_once(manifests: DataFrame, published: DataFrame) -> DataFrame:
    """Manifests whose digest is not in the log yet, each digest once."""
    fresh = manifests.join(published.select("digest"), "digest", "left_anti")
    return fresh.groupBy("digest").agg(F.min("publish_date").alias("publish_date"))


class PublishLog:
    """The published digests, each once, under a ledger of the batches that brought them."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = LedgerTable(spark, path, PUBLISHED)

    def read(self) -> DataFrame:
        return self.table.read()

    def append(self, manifests: DataFrame, batch: Batch | None = None) -> None:
        """Add the manifests whose digest is new; what is new is decided against the version this one follows."""
        rows = manifests.select("digest", F.col("publish_date").cast("string").alias("publish_date"))
        self.table.append(lambda logged: publish_once(rows, logged), batch)
        if len(self.table.parts()) >= FOLD_AT:
            self.table.compact(lambda logged: logged)


def edition_index(editions: DataFrame, index: DataFrame) -> DataFrame:
    """Index rows of editions that are not indexed yet: date, weekday, item count."""
    counts = editions.groupBy("edition_date").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(index.select("edition_date"), "edition_date", "left_anti").select(
        iso_day(F.col("edition_date")).alias("d"), weekday_label(F.col("edition_date")).alias("w"), "n"
    )


def edition_diff(expected: DataFrame, published: DataFrame) -> DataFrame:
    """Rows on one side only; empty means that the published edition is the expected one."""
    columns = expected.columns
    missing = expected.exceptAll(published.select(*columns)).withColumn("side", F.lit("missing"))
    extra = published.select(*columns).exceptAll(expected).withColumn("side", F.lit("unexpected"))
    return missing.unionByName(extra)


def escaped(title):
    """Title as it stands in page markup."""
    out = title
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def missing_titles(expected: DataFrame, pages: DataFrame) -> DataFrame:
    """Expected items whose page does not hold their title.

    Items meet only the page of their own edition: an equality join, then a containment test.
    ``expected`` holds ``edition, title``; ``pages`` holds ``edition, page``.
    """
    joined = expected.join(pages, "edition", "left")
    return joined.filter(~F.coalesce(F.contains(F.col("page"), escaped(F.col("title"))), F.lit(False))).drop("page")
