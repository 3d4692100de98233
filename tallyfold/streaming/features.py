"""Window features kept up to date while transactions arrive."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.alerts import STREAM_LIMITS, AnomalyLimits
from ..operators.features import flag_anomalies, window_features
from ..sinks.keyed_log import KeyedLog
from ..sinks.warehouse import Target, save
from .epochs import batch_folder, epoch_of
from .parse import triggered

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# For large state in large micro-batches: one bound of memory for all partitions of an executor, a commit writes what it changed,
# and the rows of the state are not counted.
LARGE_STATE = {f"spark.sql.streaming.stateStore.rocksdb.{name}": value for name, value in (
    ("boundedMemoryUsage", "true"), ("changelogCheckpointing.enabled", "true"), ("trackTotalNumberOfRows", "false"))}
BATCH_COLUMN = "written_by"
FEATURE_KEYS = ("window_start", "window_end", "customer_id")


@dataclass(frozen=True)
class FeatureSettings:
    """``watermark`` bounds the state and drops rows later than that; None keeps all windows."""

    time_window: str = "10 minutes"
    slide: str = "5 minutes"
    limits: AnomalyLimits = STREAM_LIMITS
    watermark: str | None = "1 minute"


def feature_rows(transactions: DataFrame, settings: FeatureSettings = FeatureSettings()) -> DataFrame:
    """Flagged window features of a stream, or of a table, where the watermark has no effect."""
    if transactions.isStreaming and settings.watermark:
        transactions = transactions.withWatermark("timestamp", settings.watermark)
    return flag_anomalies(window_features(transactions, settings.time_window, settings.slide), settings.limits)


def feature_log(path: str, schema: T.StructType) -> KeyedLog:
    return KeyedLog(path, FEATURE_KEYS, schema)


def start_upserts(rows: DataFrame, log: KeyedLog, checkpoint: str, every: str | None = "5 seconds") -> StreamingQuery:
    """Write every refreshed window; the log returns the last state of each.

    The caller waits for, or stops, the returned query.
    """
    log.create(rows.sparkSession)
    epoch = epoch_of(rows.sparkSession, checkpoint, f"{log.path}/versions")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        log.write(batch, batch_id, epoch)

    writer = rows.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


def start_appends(rows: DataFrame, path: str, checkpoint: str, every: str | None = "5 seconds") -> StreamingQuery:
    """Write each row once; a window when the watermark has passed it."""
    writer = (rows.writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint))
    return triggered(writer, every).start()


def start_sink(rows: DataFrame, table: str, target: Target, checkpoint: str, every: str | None = "5 seconds",
               output_mode: str = "append") -> StreamingQuery:
    """Append every micro-batch to a warehouse table, once.

    On a files target a micro-batch replaces its own (epoch, batch) folder below the table, so a retry adds nothing.
    Other targets cannot replace part of a table: there every row carries its batch in ``BATCH_COLUMN``, by which a
    repeated append is told apart. In update mode every refresh of a window adds a row: prefer append mode with a
    watermark here, or ``start_upserts``.
    """
    place = target.writer_options(table).get("path")
    epoch = epoch_of(rows.sparkSession, checkpoint, *([place] if place else []))

    def append(batch: DataFrame, batch_id: int) -> None:
        if place:
            save(batch, "", replace(target, table_layout=batch_folder(place, epoch, batch_id)), "overwrite")
        else:
            save(batch.withColumn(BATCH_COLUMN, F.lit(f"{epoch}-{batch_id}")), table, target, "append")

    writer = rows.writeStream.outputMode(output_mode).foreachBatch(append).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None, on_disk: bool = False, large: bool = False):
    """Start stateful queries inside: their first run fixes the number of state partitions for good.

    ``on_disk`` keeps state in RocksDB instead of executor memory, for very many customers; ``large`` adds ``LARGE_STATE``.
    """
    wanted = dict(LARGE_STATE) if large else {}
    if partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    if on_disk:
        wanted["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
