"""Rows that come too late for their windows are kept instead of dropped.

Spark's windows drop what the watermark has passed without a trace. Here the rows of every micro-batch are judged by
the same watermark, the latest event time of the micro-batches before less the delay, and those of no use to any open window go
to a table of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.panes import micros
from ..workspace import subfolders
from .epochs import MARK, batch_folder, epoch_of
from .features import FeatureSettings
from .parse import triggered

LATE, NO_TIME = "late", "no event time"


def closed_windows(event_time: str, watermark_us: int | None, settings: FeatureSettings) -> tuple[Column, Column]:
    """How many windows a row is in, and how many of them the watermark has closed."""
    window, slide = micros(settings.time_window), micros(settings.slide)
    at = F.unix_micros(F.col(event_time).cast("timestamp"))
    newest = at - F.pmod(at, F.lit(slide))
    ends = F.filter(F.transform(F.sequence(F.lit(0), F.lit(-(-window // slide) - 1)),
                                lambda k: newest - k.cast("long") * F.lit(slide) + F.lit(window)), lambda end: end > at)
    passed = F.lit(0) if watermark_us is None else F.size(F.filter(ends, lambda end: end <= F.lit(watermark_us)))
    return F.size(ends), passed


def start_late_split(transactions: DataFrame, accepted: str, late: str, log: str, checkpoint: str,
                     settings: FeatureSettings = FeatureSettings(), every: str | None = "5 seconds",
                     event_time: str = "timestamp") -> StreamingQuery:
    """Land rows with an open window under ``accepted``, the others, with the ``reason``, under ``late``.

    ``closed_windows`` tells for how many of its windows a row came too late, also for accepted ones. ``log`` has the watermark
    that each micro-batch leaves to the next. Every micro-batch replaces its own folders, so replaying one changes nothing.
    """
    spark = transactions.sparkSession
    epoch = epoch_of(spark, checkpoint, accepted, late, log)
    delay = micros(settings.watermark)
    at = F.unix_micros(F.col(event_time).cast("timestamp"))

    def latest_before(batch_id: int) -> int | None:
        if f"batch_id={batch_id - 1}" not in subfolders(spark, f"{log}/{MARK}{epoch}"):
            return None
        return spark.read.schema("latest_us bigint").parquet(batch_folder(log, epoch, batch_id - 1)).first()[0]

    def land(batch: DataFrame, batch_id: int) -> None:
        before = latest_before(batch_id)
        # Spark keeps its watermark in milliseconds.
        watermark = None if before is None else (before - delay) // 1000 * 1000
        windows, closed = closed_windows(event_time, watermark, settings)
        judged = batch.withColumns({"closed_windows": F.coalesce(closed, F.lit(0)), "_windows": windows}).persist()
        try:
            reason = F.when(F.col(event_time).isNull(), NO_TIME).when(F.col("closed_windows") == F.col("_windows"), LATE)
            marked = judged.withColumn("reason", reason).drop("_windows")
            marked.where("reason is null").drop("reason").write.mode("overwrite").parquet(batch_folder(accepted, epoch, batch_id))
            marked.where("reason is not null").write.mode("overwrite").parquet(batch_folder(late, epoch, batch_id))
            latest = judged.agg(F.max(at).alias("latest_us")).select(F.greatest("latest_us", F.lit(before).cast("long")).alias("latest_us"))
            latest.coalesce(1).write.mode("overwrite").parquet(batch_folder(log, epoch, batch_id))
        finally:
            judged.unpersist()

    return triggered(transactions.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint), every).start()
