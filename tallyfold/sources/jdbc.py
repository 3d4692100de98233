"""Relational source read by parallel range queries."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from .files import on_day


@dataclass(frozen=True)
class JdbcTable:
    url: str
    table: str
    fetch_size: int = 10000
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {**self.properties, "url": self.url, "dbtable": self.table, "fetchsize": str(self.fetch_size)}


def split_options(column: str, lower, upper, partitions: int) -> dict[str, str]:
    """Options that make Spark read ``partitions`` ranges of ``column`` at once."""
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions)}


def read_jdbc(spark: SparkSession, source: JdbcTable, split: dict[str, str] | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**source.options(), **(split or {})).load()


def read_jdbc_day(spark: SparkSession, source: JdbcTable, column: str, day: date, partitions: int = 16) -> DataFrame:
    """One day of a table: the day is filtered in the database and read in ``partitions`` time slices."""
    midnight = "{} 00:00:00"
    split = split_options(column, midnight.format(day), midnight.format(day + timedelta(days=1)), partitions)
    return on_day(read_jdbc(spark, source, split), column, day)
