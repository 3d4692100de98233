"""Idempotent upsert of streaming results on plain files.

Each micro-batch replaces its own folder, so a batch that is replayed after a
failure leaves no second copy. The newest (epoch, batch) wins per key when reading.

Every ``snapshot_every`` batches the state before the batch is written as a snapshot, and the versions that the
snapshot before it covers are deleted: a read takes one snapshot and the batches after it, however old the stream is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from ..operators.dedup import dedup_by_key
from ..streaming.epochs import MARK, batch_folder
from ..workspace import remove_folder, subfolders

Batch = tuple[int, int]
_PLACE = [T.StructField("epoch", T.LongType()), T.StructField("batch_id", T.LongType())]


@dataclass(frozen=True)
class KeyedLog:
    path: str
    keys: Sequence[str]
    schema: T.StructType
    snapshot_every: int = 50

    @property
    def _versions(self) -> str:
        return f"{self.path}/versions"

    @property
    def _snapshots(self) -> str:
        return f"{self.path}/snapshots"

    def create(self, spark: SparkSession) -> None:
        """Make the log readable before its first batch."""
        spark.createDataFrame([], self.schema).coalesce(1).write.mode("ignore").parquet(batch_folder(self._versions, 0, -1))

    def _batches(self, spark: SparkSession, path: str) -> list[Batch]:
        """Finished batches under a folder, oldest first."""
        return sorted((int(e.removeprefix(MARK)), int(b.removeprefix("batch_id=")))
                      for e in subfolders(spark, path) for b in subfolders(spark, f"{path}/{e}", finished=True))

    def write(self, batch: DataFrame, batch_id: int, epoch: int = 0) -> None:
        if batch_id > 0 and batch_id % self.snapshot_every == 0:
            self.snapshot(batch.sparkSession, (epoch, batch_id))
        batch.write.mode("overwrite").parquet(batch_folder(self._versions, epoch, batch_id))

    def snapshot(self, spark: SparkSession, before: Batch) -> None:
        """Keep the state before a batch in one place, and drop what the last snapshot already covers.

        What this snapshot covers stays until the next one, for reads that have begun.
        """
        kept = self._batches(spark, self._snapshots)
        if before in kept:  # the batch is replayed
            return
        covered = [b for b in kept if b < before]
        self.current(spark, before).write.mode("overwrite").parquet(batch_folder(self._snapshots, *before))
        if covered:
            for old in self._batches(spark, self._versions):
                if old < covered[-1]:
                    remove_folder(spark, batch_folder(self._versions, *old))
            for old in covered[:-1]:
                remove_folder(spark, batch_folder(self._snapshots, *old))

    def _read(self, spark: SparkSession, root: str, batches: Sequence[Batch]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *_PLACE])
        if not batches:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", root).parquet(*[batch_folder(root, *b) for b in batches])

    def history(self, spark: SparkSession) -> DataFrame:
        """Every kept version of every key."""
        return self._read(spark, self._versions, self._batches(spark, self._versions))

    def current(self, spark: SparkSession, before: Batch | None = None, only: DataFrame | None = None) -> DataFrame:
        """The last version of every key, or the last one written before a micro-batch.

        ``only`` has a column ``_seen``: just those values of the (single) key are looked at.
        """
        usable = lambda b: before is None or b < before
        snapshots = [b for b in self._batches(spark, self._snapshots) if before is None or b <= before]
        newest = snapshots[-1:]
        later = [b for b in self._batches(spark, self._versions) if usable(b) and (not newest or b >= newest[0])]
        versions = self._read(spark, self._versions, later)
        if newest:  # a snapshot is older than any version read with it
            packed = self._read(spark, self._snapshots, newest).withColumn("batch_id", F.col("batch_id") - 1)
            versions = packed.unionByName(versions)
        if only is not None:
            versions = versions.join(only, F.col(self.keys[0]).eqNullSafe(F.col("_seen")), "left_semi")
        # A key has a row for every batch since the last snapshot at most.
        return dedup_by_key(versions, self.keys, [F.col("epoch").desc(), F.col("batch_id").desc()], repeated=False).drop(
            "epoch", "batch_id")

    def compact(self, spark: SparkSession, into: str) -> KeyedLog:
        """Write the current versions to another folder as a new log, while this one goes on."""
        packed = KeyedLog(into, self.keys, self.schema, self.snapshot_every)
        self.current(spark).write.mode("error").parquet(batch_folder(packed._versions, 0, -1))
        return packed
