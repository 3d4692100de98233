"""Sliding-window features for windows that are many slides long.

A window is a row of panes, a pane being as long as the common divisor of window and slide. Rows are combined into one set of
moments (count, mean, sum of squared distances) per customer and pane before anything moves, so the shuffle carries
panes and not ``window / slide`` copies of every row.

Panes are put into blocks as long as a window. A window that starts in a block is the block's panes from its start on and the next
block's panes up to its end: two running sums, one backwards and one forwards, and no sum is ever subtracted. Each pane
goes to its block and to the one before, so all windows that start in a block are finished there. A customer's blocks are
separate groups of at most two windows' panes, whatever the customer's number of rows.

Between two starts at which a pane enters or leaves, the windows are equal. They are one row with the first and the
last start until ``each_window`` writes them out.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..settings import MAX_PARTITIONS, initial_partitions

# Panes of one task: a pane with its copy and their entries takes about 6 KB in sorts and sums.
TASK_PANES = 100_000
_UNITS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
          "day": 86_400_000_000, "week": 604_800_000_000}


def micros(duration: str) -> int:
    """Microseconds of a text such as ``24 hours``."""
    parts = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", duration.lower())
    if not parts or parts[2] not in _UNITS or not int(parts[1]):
        raise ValueError(f"no duration: {duration!r}")
    return int(parts[1]) * _UNITS[parts[2]]


def _down(at: Column, step: int) -> Column:
    return at - F.pmod(at, F.lit(step))


def _up(at: Column, step: int) -> Column:
    return at + F.pmod(-at, F.lit(step))


def pane_moments(df: DataFrame, pane: int, *, event_time: str = "timestamp", amount: str = "amount",
                 key: str = "customer_id") -> DataFrame:
    """``key, pane`` (start in microseconds) with ``rows, n, mean, m2`` of the amounts. Rows without event time are in no pane."""
    at = F.unix_micros(F.col(event_time).cast("timestamp"))
    return (df.where(F.col(event_time).isNotNull())
            .groupBy(F.col(key), _down(at, pane).alias("pane"))
            .agg(F.count("*").alias("rows"), F.count(amount).alias("n"), F.avg(amount).alias("mean"),
                 (F.var_pop(amount) * F.count(amount)).alias("m2")))


def window_runs(panes: DataFrame, window: int, slide: int, pane: int, key: str = "customer_id", tasks: int = 1) -> DataFrame:
    """Runs of equal windows: ``first_start, last_start`` in microseconds, and the features.

    ``tasks`` is the least number of tasks that the panes need: a pane that has moved is small, but it becomes up to seven sorted
    entries on either side, so partitions must not be merged by the bytes that moved.
    """
    spark = panes.sparkSession
    tasks = max(tasks, min(initial_partitions(spark), spark.sparkContext.defaultParallelism))
    block = F.expr(f"(pane - pmod(pane, {window}L)) div {window}L")
    placed = panes.withColumn("_own", block).withColumn("_next", F.explode(F.array(F.lit(False), F.lit(True))))
    placed = placed.withColumn("_block", F.when(F.col("_next"), F.col("_own") - 1).otherwise(F.col("_own"))).drop("_own").repartition(
        tasks, F.col(key), F.col("_block"))
    group = [key, "_block"]
    whole = Window.partitionBy(*group)
    sound = F.when(~F.isnan("mean"), F.col("mean"))
    # Sums of distances to a value near the mean keep their digits.
    shifted = placed.withColumn("_ref", F.coalesce(F.avg(sound).over(whole), F.lit(0.0))).withColumn("_far", F.col("mean") - F.col("_ref"))
    begin = F.col("_block") * F.lit(window)

    def entry(side: Column, at: Column, start: Column, asks: int, *moments: Column) -> Column:
        names = ("rows", "n", "s1", "s2")
        return F.struct(side.alias("_side"), at.alias("_at"), start.alias("_start"), F.lit(asks).alias("_asks"),
                        *[m.alias(n) for m, n in zip(moments, names)])

    pane_entry = entry(F.col("_next"), F.col("pane"), F.lit(None).cast("long"), 0, F.col("rows"), F.col("n"),
                       F.coalesce(F.col("n") * F.col("_far"), F.lit(0.0)),
                       F.coalesce(F.col("m2") + F.col("n") * F.col("_far") * F.col("_far"), F.lit(0.0)))
    nothing = (F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(0.0), F.lit(0.0))
    changes = F.array(_up(begin, slide), _up(F.col("pane") - F.lit(window - pane), slide), _up(F.col("pane") + F.lit(pane), slide))
    starts = F.filter(F.array_distinct(changes), lambda s: (s >= begin) & (s < begin + F.lit(window)))
    # A start asks for the block's panes from it on, and for the next block's panes up to the window's end. Several panes may name it.
    asked = F.flatten(F.transform(starts, lambda s: F.array(
        entry(F.lit(False), s, s, 1, *nothing), entry(F.lit(True), s + F.lit(window - pane), s, 1, *nothing))))
    entries = shifted.select(*group, "_ref", F.inline(F.concat(F.array(pane_entry), asked)))
    # The block's own panes from the last on, the next block's from the first on; a pane comes before the start that includes it.
    onwards = Window.partitionBy(*group, "_side").orderBy(
        F.when(F.col("_side"), F.col("_at")).otherwise(-F.col("_at")), "_asks").rowsBetween(Window.unboundedPreceding, 0)
    sums = {c: F.sum(c).over(onwards) for c in ("rows", "n", "s1", "s2")}

    def both_sides(c: str) -> Column:
        return sum(F.first(F.when(F.col("_side") == side, F.col(c)), ignorenulls=True) for side in (False, True))

    found = (entries.withColumns(sums).where("_asks = 1")
             .groupBy(*group, "_ref", "_start").agg(*[both_sides(c).alias(c) for c in sums]))
    in_order = Window.partitionBy(*group).orderBy("_start")
    until = F.coalesce(F.lead("_start").over(in_order), _up(begin + F.lit(window), slide))
    n, s1, s2 = F.col("n"), F.col("s1"), F.col("s2")
    spread = F.when(n > 1, F.sqrt(F.greatest(s2 - s1 * s1 / n, F.lit(0.0)) / (n - 1)))
    return (found.withColumn("last_start", until - F.lit(slide)).where("rows > 0")
            .select(key, F.col("_start").alias("first_start"), "last_start",
                    F.when(n > 0, F.col("_ref") + s1 / n).alias("rolling_avg_amount"),
                    spread.alias("stddev_amount"), F.col("rows").alias("transaction_count")))


def each_window(runs: DataFrame, window: int, slide: int, key: str = "customer_id") -> DataFrame:
    """A row per window, as ``window_features`` gives them."""
    start = F.explode(F.sequence("first_start", "last_start", F.lit(slide)))
    return runs.withColumn("_start", start).select(
        F.timestamp_micros("_start").alias("window_start"), F.timestamp_micros(F.col("_start") + F.lit(window)).alias("window_end"), key,
        "rolling_avg_amount", "stddev_amount", "transaction_count")


def pane_window_runs(df: DataFrame, time_window: str, slide: str, *, event_time: str = "timestamp", amount: str = "amount",
                     key: str = "customer_id") -> DataFrame:
    """Runs of equal windows of a table. Windows start at multiples of ``slide`` since the epoch."""
    window, step = micros(time_window), micros(slide)
    if step > window:
        raise ValueError("the slide must not exceed the window")
    pane = math.gcd(window, step)
    # There are no more panes than rows, and those of files are counted by their footers.
    tasks = min(-(-df.count() // TASK_PANES), MAX_PARTITIONS)
    return window_runs(pane_moments(df, pane, event_time=event_time, amount=amount, key=key), window, step, pane, key, tasks)


def pane_window_features(df: DataFrame, time_window: str = "10 minutes", slide: str = "5 minutes", *,
                         event_time: str = "timestamp", amount: str = "amount", key: str = "customer_id") -> DataFrame:
    """``operators.features.window_features`` by panes: the same rows, for windows of many slides."""
    runs = pane_window_runs(df, time_window, slide, event_time=event_time, amount=amount, key=key)
    return each_window(runs, micros(time_window), micros(slide), key)
