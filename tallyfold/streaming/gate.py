"""Row rules as a gate inside a stream, counted while the rows pass."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.alerts import error_alert
from ..quality.rules import Rule
from ..quality.suite import with_failed_rules
from .parse import triggered

COUNTERS = "gate"


def gated(rows: DataFrame, rules: Sequence[Rule], as_of: datetime | None = None) -> DataFrame:
    """``rows`` with ``failed_rules`` and ``accepted``: no critical rule failed.

    Each micro-batch reports how many rows came, were accepted and rejected, and failed each rule.
    """
    critical = F.array(*[F.lit(r.name) for r in rules if r.severity == "critical"]).cast("array<string>")
    judged = with_failed_rules(rows, rules, as_of=as_of).withColumn("accepted", ~F.arrays_overlap("failed_rules", critical))
    return judged.observe(
        COUNTERS, F.count(F.lit(1)).alias("rows"), F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"),
        *[F.count_if(F.array_contains("failed_rules", r.name)).alias(f"failed {r.name}") for r in rules])


def start_gate(rows: DataFrame, rules: Sequence[Rule], path: str, checkpoint: str, every: str | None = "5 seconds",
               as_of: datetime | None = None) -> StreamingQuery:
    """Land all rows under ``path``, accepted and rejected ones in folders of their own, from one read and one write."""
    writer = (gated(rows, rules, as_of).writeStream.outputMode("append").format("parquet").partitionBy("accepted")
              .option("path", path).option("checkpointLocation", checkpoint))
    return triggered(writer, every).start()


def rejection_alerts(counters: DataFrame, limit: int = 5) -> DataFrame:
    """Micro-batches with their rejected rows; an alert from ``limit`` on."""
    rejected = counters.where(F.col("name") == "rejected")
    return rejected.select("pipeline", "batch_id", F.col("value").alias("errors"), error_alert(F.col("value"), limit).alias("alert"))
