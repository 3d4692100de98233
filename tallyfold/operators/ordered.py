"""Per-customer row frames: moving average and z-score.

A plain window puts all rows of one customer into one task. That is kept for
customers of ordinary size. Rows of heavy customers are range-partitioned by
(customer, order), which cuts such a customer into runs of about equal size,
and each run is given the few rows before it that its first frames reach into.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.cleaning import flag
from ..settings import initial_partitions
from ..workspace import run_dir
from .skew import HeavyKeys, aggregate_keys, heavy_keys, lookup_left_join

RUN = "_run"


def _cut_into_runs(df: DataFrame, key: str, order_by: Sequence[str], runs: int) -> DataFrame:
    """Rows in consecutive runs numbered by ``_run``.

    The row number in ``_tie`` lets even exact copies of one row be cut. Range
    bounds come from a sample and may differ between executions, so the numbered
    rows are written before anything reads them twice.
    """
    spark = df.sparkSession
    path = run_dir(spark, "runs")
    order = [F.col(c).asc_nulls_first() for c in (key, *order_by, "_tie")]
    cut = (df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(max(2, runs), *order).drop("_tie")
           .withColumn(RUN, F.spark_partition_id()))
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def _rows_before(runs: DataFrame, key: str, order_by: Sequence[str], reach: int) -> DataFrame:
    """For every (customer, run): the last ``reach`` rows of that customer in earlier runs.

    Every run of a customer has at least one of its rows, so the last
    ``reach`` rows lie within the ``reach`` runs before.
    """
    newest_first = Window.partitionBy(key, RUN).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    ends = (runs.select(key, RUN, *order_by)
            .withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") <= reach)
            .groupBy(key, RUN)
            .agg(F.sort_array(F.collect_list(F.struct((-F.col("_rank")).alias("_rank"), *order_by))).alias("_tail")))
    earlier = Window.partitionBy(key).orderBy(RUN).rowsBetween(-reach, -1)
    before = F.flatten(F.collect_list("_tail").over(earlier))
    return (ends.select(key, RUN, F.slice(before, F.greatest(F.size(before) - reach + 1, F.lit(1)), reach).alias("_b"))
            .select(key, RUN, F.explode("_b").alias("_b"))
            .select(key, RUN, "_b.*").drop("_rank"))


def with_row_frame(df: DataFrame, key: str, order_by: Sequence[str], values: Sequence[str], frame: tuple[int, int],
                   outputs: Callable[[WindowSpec], dict[str, Column]], *, heavy: HeavyKeys | None = None,
                   runs: int | None = None) -> DataFrame:
    """Add columns computed over ``rows between frame[0] and frame[1]`` of each key.

    ``frame`` looks back only; ``values`` are the columns ``outputs`` reads.
    They break ties of ``order_by``, so rows that still tie are interchangeable.
    """
    first, last = frame
    order_by = [*order_by, *[v for v in values if v not in order_by]]
    if first > last or last > 0:
        raise ValueError("the frame must end at or before the current row")
    ascending = [F.col(c).asc_nulls_first() for c in order_by]
    if heavy is None:
        heavy = heavy_keys(df, key)
    plain = Window.partitionBy(key).orderBy(*ascending).rowsBetween(first, last)
    if not heavy:
        return df.withColumns(outputs(plain))
    marks = heavy.frame(df)
    is_heavy = F.col(key).eqNullSafe(marks["_heavy_key"])
    cold = df.join(marks, is_heavy, "left_anti").withColumns(outputs(plain))
    if runs is None:
        # A run may hold the pieces of many customers; only its number of rows matters to a task.
        runs = min(heavy.pieces, max(heavy.tasks, initial_partitions(df.sparkSession)))
    cut = _cut_into_runs(df.join(marks, is_heavy, "left_semi"), key, order_by, runs)
    halo = _rows_before(cut, key, order_by, -first).withColumn("_halo", F.lit(True))
    # The rows before come first even where they tie with a copy of themselves in the run.
    within = Window.partitionBy(key, RUN).orderBy(F.col("_halo").desc(), *ascending).rowsBetween(first, last)
    hot = (cut.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
           .withColumns(outputs(within)).where("not _halo").drop("_halo", RUN))
    return cold.unionByName(hot)


def usable(amount: str) -> Column:
    """NaN counts as a missing amount."""
    return F.when(~F.isnan(amount), F.col(amount))


def moving_average(df: DataFrame, rows: int = 5, *, key: str = "customer_id", amount: str = "amount",
                   order_by: Sequence[str] = ("timestamp", "transaction_id"), heavy: HeavyKeys | None = None,
                   runs: int | None = None) -> DataFrame:
    """``moving_avg_amount``: mean of this and the ``rows - 1`` transactions before it; null and NaN are left out."""
    return with_row_frame(df, key, order_by, [amount], (1 - rows, 0),
                          lambda w: {"moving_avg_amount": F.avg(usable(amount)).over(w)}, heavy=heavy, runs=runs)


def scored(df: DataFrame, amount: str, threshold: float) -> DataFrame:
    usable = F.col("baseline_stddev") > 0
    z = F.when(usable, (F.col(amount) - F.col("baseline_avg")) / F.col("baseline_stddev"))
    far = usable & (F.abs(F.col(amount) - F.col("baseline_avg")) > F.lit(threshold) * F.col("baseline_stddev"))
    return df.withColumns({"z_score": z, "z_flag": flag(far)})


def zscore_previous(df: DataFrame, rows: int = 5, threshold: float = 2.5, *, key: str = "customer_id",
                    amount: str = "amount", order_by: Sequence[str] = ("timestamp", "transaction_id"),
                    heavy: HeavyKeys | None = None, runs: int | None = None) -> DataFrame:
    """Distance of an amount from the ``rows`` transactions before it, in their deviations."""
    framed = with_row_frame(df, key, order_by, [amount], (-rows, -1),
                            lambda w: {"baseline_avg": F.avg(amount).over(w),
                                       "baseline_stddev": F.stddev_samp(amount).over(w)}, heavy=heavy, runs=runs)
    return scored(framed, amount, threshold)


def zscore_history(df: DataFrame, threshold: float = 2.5, *, key: str = "customer_id", amount: str = "amount",
                   min_rows: int | None = None, broadcast_rows: int | None = None) -> DataFrame:
    """Distance of an amount from all transactions of its customer; 0 without a customer.

    The baseline is a combined aggregate joined back, not a window: a window
    would hold every row of a customer in one task.
    """
    baseline = aggregate_keys(df, key, min_rows=min_rows, broadcast_rows=broadcast_rows, baseline_avg=F.avg(amount), baseline_stddev=F.stddev_samp(amount))
    return scored(lookup_left_join(df, baseline).drop("occurrences"), amount, threshold)
