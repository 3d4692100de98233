"""Message bytes to typed transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ..schemas import STREAM_TRANSACTION
from .epochs import batch_folder, epoch_of


def _unreadable() -> Column:
    """No field could be read: malformed text, no object, or an empty message."""
    return F.coalesce(*[F.col(name).cast("string") for name in STREAM_TRANSACTION.names]).isNull()


def _parsed(messages: DataFrame) -> DataFrame:
    """``value`` as text and the fields. No filter moves below ``inline``, so each message is parsed once."""
    text = F.col("value").cast("string")
    return messages.select(text.alias("_text"), F.inline(F.array(F.from_json(text, STREAM_TRANSACTION))))


def _halves(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (parsed.where(~_unreadable()).select(*STREAM_TRANSACTION.names),
            parsed.where(_unreadable()).select(F.col("_text").alias("value")))


def parse_transactions(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split messages with a binary ``value`` into transactions and rejected messages.

    A field of the wrong type is null and the rest of its record is kept.
    """
    return _halves(_parsed(messages))


def start_landing(messages: DataFrame, accepted: str, rejected: str, checkpoint: str,
                  every: str | None = "5 seconds") -> StreamingQuery:
    """Land both halves from one read of the source.

    Every micro-batch replaces its own two folders, so replaying one adds nothing. The folders bear the
    checkpoint's epoch, so a query with another checkpoint adds to what is there.
    """
    epoch = epoch_of(messages.sparkSession, checkpoint, accepted, rejected)

    def land(batch: DataFrame, batch_id: int) -> None:
        parsed = _parsed(batch).persist()
        try:
            for half, path in zip(_halves(parsed), (accepted, rejected)):
                half.write.mode("overwrite").parquet(batch_folder(path, epoch, batch_id))
        finally:
            parsed.unpersist()

    return triggered(messages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint), every).start()


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run at an interval, or once over what is there now."""
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
