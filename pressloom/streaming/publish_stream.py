"""ST5: the publish log for manifests that arrive as files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pressloom.operators.publish import PublishLog
from pressloom.operators.ledger import Batch, run_batches


def run_publish_stream(manifests: DataFrame, log: PublishLog, checkpoint: str) -> None:
    """Log all waiting manifests whose digest is new, and stop.

    A digest enters the log once: a replayed batch is known by its number, and the manifests of a new
    checkpoint, which brings all of them again, by their digests. Both are decided by the version that is published.
    """

    def add(batch: DataFrame, checkpoint_id: str, number: int) -> None:
        log.append(batch, Batch(checkpoint_id, checkpoint_id, number))

    run_batches(manifests, checkpoint, add)
