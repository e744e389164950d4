"""An append table with a ledger: which batches of which streams it holds is part of every version.

Each batch writes one part; the next manifest names the part and the batch together, so a batch counts once
whether its run is replayed, ends half-way or meets another writer.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pressloom.operators.manifest import ManifestLog, VersionTaken

TRIES = 20


class StreamMismatch(ValueError):
    """A stream under a new checkpoint would repeat what the table holds already."""


@dataclass(frozen=True)
class Batch:
    """A batch of a stream: the stream's name, the identity its checkpoint gives it, the number of the batch."""

    stream: str
    checkpoint_id: str
    number: int


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that a checkpoint gives its query; a new checkpoint has a new one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


class LedgerTable:
    """Parts under a manifest that also holds the last batch of each stream."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.log = ManifestLog(spark, path)

    def parts(self) -> list[str]:
        return self.log.newest()[1].get("parts", [])

    def read(self) -> DataFrame:
        return self.read_parts(self.parts())

    def read_parts(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{part}" for part in parts])

    def append(self, build: Callable[[DataFrame], DataFrame], batch: Batch | None = None) -> str | None:
        """Add ``build(rows so far)`` as a part, once per batch; rebuilt if another writer publishes first. Returns the part.

        A batch under another checkpoint than the stream's earlier batches raises: its input would count twice.
        """
        for _ in range(TRIES):
            version, manifest = self.log.newest()
            parts, streams = manifest.get("parts", []), manifest.get("streams", {})
            if batch is not None:
                known = streams.get(batch.stream)
                if known and known["checkpoint"] != batch.checkpoint_id:
                    raise StreamMismatch(f"stream {batch.stream!r} fills {self.path} from another checkpoint")
                if known and known["batch"] >= batch.number:
                    return None
                streams = {**streams, batch.stream: {"checkpoint": batch.checkpoint_id, "batch": batch.number}}
            part = self._publish(version, build(self.read_parts(parts)), parts, streams)
            if part:
                return part
        raise VersionTaken(f"{self.path} did not come to rest")

    def compact(self, fold: Callable[[DataFrame], DataFrame]) -> None:
        """Replace all parts by one that holds ``fold`` of their rows; the ledger stays."""
        for _ in range(TRIES):
            version, manifest = self.log.newest()
            if len(manifest.get("parts", [])) < 2:
                return
            if self._publish(version, fold(self.read_parts(manifest["parts"])), [], manifest["streams"]):
                return
        raise VersionTaken(f"{self.path} did not come to rest")

    def _publish(self, version: int | None, rows: DataFrame, parts: list[str], streams: dict) -> str | None:
        part = f"part-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{part}")
        try:
            self.log.publish(0 if version is None else version + 1, {"parts": [*parts, part], "streams": streams})
            return part
        except VersionTaken:
            self.log.remove(part)
            return None

    def expire(self, keep: int = 2) -> list[str]:
        """Remove old versions and the parts that only they name."""
        return self.log.expire(keep, lambda manifest: set(manifest["parts"]))


def run_batches(frame: DataFrame, checkpoint: str, act: Callable[[DataFrame, str, int], None]) -> None:
    """Hand all waiting batches of a streaming frame to ``act(rows, checkpoint id, number)`` and stop."""
    spark = frame.sparkSession

    def one(batch: DataFrame, number: int) -> None:
        act(batch, checkpoint_id(spark, checkpoint), number)

    frame.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
