"""ST1, ST2: the store merge for records that arrive as files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pressloom.operators.store import RecordStore, observations, project_news
from pressloom.operators.ledger import run_batches


def run_store_stream(arrivals: DataFrame, store: RecordStore, checkpoint: str) -> None:
    """Merge all waiting arrivals and stop.

    ``arrivals`` is a streaming frame of raw items with ``run_ts`` and ``arrival_seq``. Each batch goes into the
    newest version, also where the store was filled before this checkpoint, and touches only the buckets of its
    records; the version holds the batch's number under the checkpoint's identity, so a replay after a lost driver
    changes nothing.
    """

    def merge_batch(batch: DataFrame, checkpoint_id: str, number: int) -> None:
        records = observations(project_news(batch, keep=["run_ts", "arrival_seq"]))
        store.merge(records, batch=(checkpoint_id, number))

    run_batches(arrivals, checkpoint, merge_batch)
