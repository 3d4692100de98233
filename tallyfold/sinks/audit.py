"""Load log, its retention, and the bad-record limit."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import LOAD_AUDIT
from ..workspace import move_folder, remove_folder, subfolders
from .warehouse import Target, save


def audited_save(df: DataFrame, table: str, target: Target, log_path: str, mode: str = "append", prefix: str = "") -> str:
    """Save and append one log row, also when the save fails. Returns the load id."""
    load_id, started = uuid.uuid4().hex, datetime.now(timezone.utc)
    rows, status = None, "error"
    try:
        rows = save(df, table, target, mode, prefix)
        status = "ok"
    finally:
        entry = (load_id, prefix + table, rows, started, datetime.now(timezone.utc), status)
        df.sparkSession.createDataFrame([entry], LOAD_AUDIT).coalesce(1).write.mode("append").parquet(log_path)
    return load_id


def read_audit(spark: SparkSession, log_path: str) -> DataFrame:
    return spark.read.schema(LOAD_AUDIT).parquet(log_path)


def within_retention(log: DataFrame, as_of: Column, days: int = 30, column: str = "finished") -> DataFrame:
    return log.where(F.col(column) >= as_of - F.make_dt_interval(F.lit(days)))


def prune_audit(spark: SparkSession, log_path: str, as_of: Column, days: int = 30) -> None:
    """Replace the log by its entries that are still within retention.

    They are written beside it first, so a failure leaves the old log, the new one, or both folders, but never
    neither. Run while nothing is loaded.
    """
    kept = f"{log_path}.kept"
    within_retention(read_audit(spark, log_path), as_of, days).coalesce(1).write.mode("overwrite").parquet(kept)
    spark.read.schema(LOAD_AUDIT).parquet(kept).coalesce(1).write.mode("overwrite").parquet(log_path)
    remove_folder(spark, kept)


class TooManyBadRecords(RuntimeError):
    pass


def check_bad_records(rejected: DataFrame, limit: int = 5) -> None:
    """Fail when more than ``limit`` rows were rejected; reads no further than needed."""
    if rejected.limit(limit + 1).count() > limit:
        raise TooManyBadRecords(f"more than {limit} rejected records")


def save_within_limit(df: DataFrame, bad: Column, path: str, limit: int = 5, mode: str = "append") -> int:
    """Write the rows that are not ``bad`` as Parquet and return their number, in one pass over ``df``.

    Bad rows are counted by the tasks that write. With more than ``limit`` of them nothing of the load is kept: it is
    written to a folder beside ``path`` and moved below it, as a folder of its own, only if the count allows.
    ``mode`` "overwrite" removes the loads before it, after the new one is in place.
    """
    spark, seen = df.sparkSession, Observation()
    is_bad = F.coalesce(bad, F.lit(False))
    load, waiting = f"load={uuid.uuid4().hex}", f"{path}.waiting"
    try:
        (df.observe(seen, F.count_if(is_bad).alias("bad"), F.count_if(~is_bad).alias("rows")).where(~is_bad)
         .write.parquet(f"{waiting}/{load}"))
        counted = seen.get
        if counted["bad"] > limit:
            raise TooManyBadRecords(f"{counted['bad']} rejected records, {limit} are allowed")
        earlier = subfolders(spark, path)
        move_folder(spark, f"{waiting}/{load}", f"{path}/{load}")
        for name in earlier if mode == "overwrite" else ():
            remove_folder(spark, f"{path}/{name}")
        return counted["rows"]
    finally:
        remove_folder(spark, f"{waiting}/{load}")
