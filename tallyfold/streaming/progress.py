"""What streaming queries did, as a table that grows with every trigger."""

from __future__ import annotations

import threading
import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..schemas import BATCH_METRIC, OBSERVED_COUNTER


class ProgressLog(StreamingQueryListener):
    """Writes a row per trigger to a folder, in the form ``operators.metrics.run_metrics`` reads.

    Spark itself keeps the last 100 triggers of a query only. Rows are written in groups of ``group``, or when the first of
    them is ``seconds`` old, and what is left when a query ends. A failed query adds a row with status ``error``. With
    ``counters``, that folder gets what the triggers observed, a row per number.
    """

    def __init__(self, spark: SparkSession, path: str, pipeline: str, group: int = 100, seconds: float = 60.0,
                 counters: str | None = None):
        self.spark, self.path, self.pipeline, self.group = spark, path, pipeline, group
        self.seconds, self.counters_path = seconds, counters
        self._rows: list[tuple] = []
        self._counters: list[tuple] = []
        self._oldest: float | None = None
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def start(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        started = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        took = timedelta(milliseconds=p.durationMs.get("triggerExecution", 0))
        observed = [(self.pipeline, p.batchId, group, name, int(value)) for group, row in (p.observedMetrics or {}).items()
                    for name, value in row.asDict().items()] if self.counters_path and p.numInputRows else []
        self._add((self.pipeline, p.batchId, started, started + took, p.numInputRows, "ok"), observed)

    def onQueryTerminated(self, event) -> None:
        if event.exception is not None:
            now = datetime.now(timezone.utc)
            self._add((self.pipeline, None, now, now, 0, "error"))
        with self._change:
            self._flush()
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def _add(self, row: tuple, observed: list[tuple] = ()) -> None:
        with self._change:
            self._rows.append(row)
            self._counters += observed
            self._oldest = self._oldest or time.monotonic()
            if len(self._rows) >= self.group or time.monotonic() - self._oldest >= self.seconds:
                self._flush()

    def _flush(self) -> None:
        if self._rows:
            self.spark.createDataFrame(self._rows, BATCH_METRIC).coalesce(1).write.mode("append").parquet(self.path)
            self._rows, self._oldest = [], None
        if self._counters:
            self.spark.createDataFrame(self._counters, OBSERVED_COUNTER).coalesce(1).write.mode("append").parquet(self.counters_path)
            self._counters = []

    def wait(self, query: StreamingQuery, seconds: float = 120) -> None:
        """Until the query has ended and all its rows are written."""
        try:
            query.awaitTermination()
        finally:
            with self._change:
                if not self._change.wait_for(lambda: str(query.runId) in self._ended, seconds):
                    raise TimeoutError("the end of the query was not reported")

    def stop(self) -> None:
        self.spark.streams.removeListener(self)
        with self._change:
            self._flush()

    def counters(self) -> DataFrame:
        """``pipeline, batch_id, observed, name, value`` of every trigger that had rows."""
        return self.spark.read.schema(OBSERVED_COUNTER).parquet(self.counters_path)

    def table(self) -> DataFrame:
        return self.spark.read.schema(BATCH_METRIC).parquet(self.path)
