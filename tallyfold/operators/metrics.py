"""Volume, freshness and run metrics as tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alerts import error_alert, latency_alert
from ..functions.cleaning import moment


def run_metrics(batches: DataFrame, latency_limit: float = 0.8) -> DataFrame:
    """Latency and throughput of every batch in a table shaped like ``schemas.BATCH_METRIC``."""
    seconds = ((F.unix_micros(F.col("finished").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp")))
               / F.lit(1e6))
    latency = F.round(seconds, 3)
    return batches.withColumns({
        "latency_seconds": latency,
        "records_per_second": F.when(seconds > 0, F.round(F.col("records") / seconds, 2)).otherwise(F.lit(0.0)),
        "latency_alert": latency_alert(latency, latency_limit),
    })


def error_counts(batches: DataFrame, limit: int = 5) -> DataFrame:
    errors = F.count_if(F.col("status") == "error")
    return (batches.groupBy("pipeline").agg(errors.alias("errors"))
            .withColumn("error_alert", error_alert(F.col("errors"), limit)))


def metric_rows(one_row: DataFrame) -> DataFrame:
    """A one-row table of numbers as ``metric, value`` rows."""
    values = [F.col(c).cast("double").alias(c) for c in one_row.columns]
    return one_row.select(*values).unpivot([], one_row.columns, "metric", "value")


def freshness(sources: Mapping[str, tuple[DataFrame, str]], as_of: datetime) -> DataFrame:
    """Newest event of each source and its distance from ``as_of`` in seconds."""
    parts = []
    for name, (df, event_time) in sources.items():
        newest = df.agg(F.max(F.col(event_time).cast("timestamp_ntz")).alias("newest"))
        parts.append(newest.select(F.lit(name).alias("source"), "newest"))
    cut = moment(as_of).cast("timestamp_ntz")
    return reduce(DataFrame.unionByName, parts).withColumn(
        "lag_seconds", F.timestamp_diff("SECOND", F.col("newest"), cut))


def latest(reports: DataFrame, *newest_first: Column) -> DataFrame:
    """The first row in the given order."""
    return reports.orderBy(*newest_first).limit(1)
