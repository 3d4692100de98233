"""File layouts: one folder per day (or other unit of time), sorted inside."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def save_partitioned(df: DataFrame, path: str, by: str = "transaction_date",
                     cluster_by: Sequence[str] = ("customer_id",), small: bool = False) -> int:
    """Replace the values of ``by`` present in ``df``, leaving other folders alone; return the row count.

    Rebalancing groups the rows of a folder into few files, and unlike a plain
    repartition it cuts a folder that is too large for one task. A ``small`` table, which one task could hold, is spread over
    the cores instead, so that its many small folders are written side by side.
    """
    seen = Observation()
    grouped = df.repartition(df.sparkSession.sparkContext.defaultParallelism, by) if small else df.hint("rebalance", by)
    # Counted after the shuffle, in the writing tasks: shuffle tasks may run again when an executor is lost.
    (grouped.sortWithinPartitions(by, *cluster_by)
     .observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))
    return seen.get["rows"]


def land_extract(df: DataFrame, path: str, run_day: date) -> None:
    """Stamp an extract with its day and replace that day only. No shuffle: files keep the read layout."""
    (df.withColumn("extraction_date", F.lit(run_day))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("extraction_date").parquet(path))
