"""Names for micro-batches that stay apart when a checkpoint is replaced.

Batch numbers start at 0 again with every new checkpoint. An epoch is written into a checkpoint when a
query first runs with it, and is greater than the epochs of all earlier ones, so (epoch, batch) names a
micro-batch for good, orders micro-batches in time, and is the same when one is replayed.
"""

from __future__ import annotations

import time

from pyspark.sql import SparkSession

from ..workspace import subfolders

MARK = "epoch="


def epoch_of(spark: SparkSession, checkpoint: str, *outputs: str) -> int:
    """The epoch of a checkpoint; a new one exceeds the clock's and all those in the output folders."""
    kept = [name for name in subfolders(spark, checkpoint) if name.startswith(MARK)]
    if kept:
        return max(int(name.removeprefix(MARK)) for name in kept)
    used = [int(name.removeprefix(MARK)) for out in outputs for name in subfolders(spark, out) if name.startswith(MARK)]
    epoch = max([time.time_ns() // 1000, *[u + 1 for u in used]])
    spark.createDataFrame([], "nothing int").write.mode("overwrite").parquet(f"{checkpoint}/{MARK}{epoch}")
    return epoch


def batch_folder(path: str, epoch: int, batch_id: int) -> str:
    return f"{path}/{MARK}{epoch}/batch_id={batch_id}"
