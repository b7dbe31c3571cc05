"""Streaming entry points.

The reference has no streaming logic: its only incremental product is the
daily MBR snapshot, a batch merge into today's partition. When summary
updates arrive as a stream, ``snapshot_sink`` lets Structured Streaming
drive that same merge per micro-batch through ``foreachBatch``. Each batch
replaces rows by key in the partitions its rows are dated, late ones included,
so replays after a failure are idempotent.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame

from rollbook.sinks.snapshot import snapshot_merge


def snapshot_sink(path: str, key: Sequence[str],
                  partition_col: str = "snapshot_date") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function merging each micro-batch into the partitions of its rows."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        snapshot_merge(batch, path, key, partition_col)
    return write
