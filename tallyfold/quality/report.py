"""From rule results to suite statistics, a report row and its message."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.alerts import quality_level, summary_text
from ..operators.metrics import latest


def concat_results(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def suite_statistics(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    good = F.count_if("success")
    return (results.groupBy(*by, "suite")
            .agg(F.count("*").alias("evaluated_expectations"), good.alias("successful_expectations"))
            .withColumns({
                "unsuccessful_expectations": F.col("evaluated_expectations") - F.col("successful_expectations"),
                "success_percent": 100 * F.col("successful_expectations") / F.col("evaluated_expectations"),
            }))


def quality_metrics(statistics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean of the suites' rates, and totals; zeros when there are no suites."""
    return statistics.groupBy(*by).agg(
        F.coalesce(F.round(F.avg("success_percent"), 2), F.lit(0.0)).alias("global_success_rate"),
        F.coalesce(F.sum("evaluated_expectations"), F.lit(0)).alias("total_checks"),
        F.coalesce(F.sum("unsuccessful_expectations"), F.lit(0)).alias("total_failures"),
    )


def with_level(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("level", quality_level(F.col("global_success_rate")))


def quality_report(statistics: DataFrame) -> DataFrame:
    """One row per suite and a ``TOTAL`` row, each with its level."""
    columns = ["suite", "success_percent", "evaluated_expectations", "unsuccessful_expectations"]
    total = with_level(quality_metrics(statistics)).select(
        F.lit("TOTAL").alias("suite"), F.col("global_success_rate").alias("success_percent"),
        F.col("total_checks").alias("evaluated_expectations"),
        F.col("total_failures").alias("unsuccessful_expectations"), "level")
    return statistics.select(*columns, quality_level(F.col("success_percent")).alias("level")).unionByName(total)


def with_message(metrics: DataFrame, day: Column, report: Column) -> DataFrame:
    return metrics.withColumn("message", summary_text(
        F.col("global_success_rate"), F.col("total_checks"), F.col("total_failures"), day, report))


def weekly(stored: DataFrame, run_time: str = "run_ts") -> DataFrame:
    """Stored suite statistics by week (Monday first)."""
    weeks = stored.withColumn("week", F.date_trunc("week", F.col(run_time)).cast("date"))
    return with_level(quality_metrics(weeks, ["week"]))


def stamp_run(metrics: DataFrame, run_id: str, run_ts: datetime | date) -> DataFrame:
    return metrics.withColumns({"run_id": F.lit(run_id), "run_ts": F.lit(run_ts)})


def last_metrics(stored: DataFrame) -> DataFrame:
    """Newest stored metrics; one row of zeros when nothing is stored."""
    newest = latest(stored, F.col("run_ts").desc(), F.col("run_id").desc())
    return newest.agg(*[F.coalesce(F.first(name), F.lit(zero)).alias(name) for name, zero in
                        (("global_success_rate", 0.0), ("total_checks", 0), ("total_failures", 0))])


def latest_report(spark: SparkSession, stored: DataFrame) -> DataFrame:
    """The newest report row; reading it fails when there is none, without a look at the input beforehand."""
    newest = latest(stored, F.col("run_ts").desc(), F.col("run_id").desc())
    row = newest.agg(F.max(F.struct(*newest.columns)).alias("_row"))  # one row, null without input
    found = F.assert_true(F.col("_row").isNotNull(), F.lit("no quality report has been stored"))
    return row.where(found.isNull()).select("_row.*")
