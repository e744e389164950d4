"""ST4: arrivals per source and civil day as a stream of additive counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.functions import times as D
from pressloom.operators.ledger import Batch, LedgerTable, run_batches

COUNTS = T.StructType([
    T.StructField("source_id", T.StringType()), T.StructField("civil_day", T.DateType()), T.StructField("arrivals", T.LongType())])
# Parts that a sink holds before they are folded into one.
FOLD_AT = 32


def day_counts(events: DataFrame) -> DataFrame:
    """Counts per source and civil day; ``events`` has ``source_id`` and the event time ``ts``."""
    return events.groupBy("source_id", D.civil_day(F.col("ts")).alias("civil_day")).agg(F.count(F.lit(1)).alias("arrivals"))


def total_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("source_id", "civil_day").agg(F.sum("arrivals").alias("arrivals"))


def run_daily_counts(events: DataFrame, sink: str, checkpoint: str, stream: str = "arrivals", fold_at: int = FOLD_AT) -> None:
    """Add the counts of all waiting batches to the sink.

    Counts add up, so nothing is held as state and an arrival counts however late it is. The sink's ledger takes each
    batch once. Several streams with inputs of their own may fill one sink under different names; a stream
    whose checkpoint was replaced raises, since its input would be counted again.
    """
    table = LedgerTable(events.sparkSession, sink, COUNTS)

    def add(batch: DataFrame, checkpoint_id: str, number: int) -> None:
        table.append(lambda _: day_counts(batch), Batch(stream, checkpoint_id, number))
        if len(table.parts()) >= fold_at:
            table.compact(total_counts)

    run_batches(events, checkpoint, add)


def read_daily_counts(spark: SparkSession, sink: str) -> DataFrame:
    """The count of every source and day over all batches."""
    return total_counts(LedgerTable(spark, sink, COUNTS).read())
