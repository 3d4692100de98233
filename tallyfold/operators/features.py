"""Sliding-window features; one function for tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.alerts import BATCH_LIMITS, AnomalyLimits, anomaly_flag


def window_features(df: DataFrame, time_window: str = "10 minutes", slide: str = "5 minutes", *,
                    event_time: str = "timestamp", amount: str = "amount", key: str = "customer_id") -> DataFrame:
    """Average, sample deviation and row count of the amounts per window and customer.

    Windows start at multiples of ``slide`` since the epoch; ``slide`` equal to
    ``time_window`` gives tumbling windows. Rows without event time are in no
    window. All three aggregates combine before the shuffle, after each row
    has been repeated ``time_window / slide`` times: keep that ratio small.
    """
    return (
        df.select(F.window(event_time, time_window, slide).alias("window"), key, F.col(amount).alias("_amount"))
        .groupBy("window", key)
        .agg(
            F.avg("_amount").alias("rolling_avg_amount"),
            F.stddev_samp("_amount").alias("stddev_amount"),
            F.count("*").alias("transaction_count"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key,
                "rolling_avg_amount", "stddev_amount", "transaction_count")
    )


def flag_anomalies(features: DataFrame, limits: AnomalyLimits = BATCH_LIMITS) -> DataFrame:
    return features.withColumn("anomaly_flag", anomaly_flag(limits))
