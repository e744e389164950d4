"""Shared helpers of the corpus operators: reading, shared storage, batches of whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.session import new_workspace

# Rows, and bytes, per Arrow batch: texts can be long, and batches stay small.
BATCH_ROWS = 256
BATCH_BYTES = 8 << 20
# Words are runs of anything but these six bytes (space, tab to carriage return).
WORD = r"[^ \t-\r]+"
GAP = r"[ \t-\r]+"


def prepare(spark: SparkSession) -> None:
    """Session settings that the Python operators rely on to keep a batch of long texts small."""
    settings = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_workspace(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def names_each_row(docs: DataFrame, key: str) -> bool:
    """Whether a column is an integer key: no null, and no two rows with the same value."""
    if docs.schema[key].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return False
    return not docs.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR key IS NULL").take(1)


def numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row, key, text, doc``: rows with a number of their own, in stored form, and all columns of the caller in ``doc``."""
    return stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"),
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc")), "numbered")


def with_text(fn: Callable[[list[str]], dict[str, list]], keys: list[str],
              text: str = "text") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function: keep ``keys`` and add the columns ``fn`` gives for a batch's texts (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [value or "" for value in batch.column(text).to_pylist()]
            columns = {key: batch.column(key) for key in keys}
            columns.update({name: pa.array(values) if isinstance(values, list) else values
                            for name, values in fn(texts).items()})
            yield pa.RecordBatch.from_pydict(columns)

    return run


def word_count(text: Column) -> Column:
    """Number of words of a whole text (null: 0), counted in the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
