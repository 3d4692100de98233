"""Transactions with the customer they belong to."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import moment
from .skew import HeavyKeys, KeyTable, flagged_keys, heavy_keys, salted_left_join

KEY = "customer_id"


def join_customers(transactions: DataFrame, customers: DataFrame, *, run_ts: datetime | None = None,
                   heavy: HeavyKeys | None = None, clash_prefix: str = "crm_") -> DataFrame:
    """Every transaction once per matching customer row, with null customer columns where none match.

    Customer columns whose name a transaction column already has get
    ``clash_prefix``. ``heavy`` may be measured beforehand, for example on the
    raw table; it steers the layout only, never the result. Transactions should
    be deduplicated: exact copies of one row of a heavy customer share a piece.
    """
    taken = set(transactions.columns) - {KEY}
    customers = customers.withColumnsRenamed({name: clash_prefix + name for name in customers.columns if name in taken})
    if heavy is None:
        heavy = heavy_keys(transactions, KEY)
    stamp = F.current_timestamp() if run_ts is None else moment(run_ts).cast("timestamp")
    spread = F.xxhash64(*[F.col(f.name) for f in transactions.schema.fields if not isinstance(f.dataType, T.MapType)])
    return salted_left_join(transactions, customers, heavy, spread).withColumn("etl_timestamp", stamp)


def orphan_keys(rows: DataFrame, key: str, reference: DataFrame, reference_key: str) -> KeyTable:
    """Non-null key values without a partner in ``reference``, with their row count."""
    known = reference.select(F.col(reference_key).alias(key), F.lit(True).alias("_known")).distinct()
    return flagged_keys(rows, key, lambda counts: counts.join(known, key, "left")
                        .withColumn("_flag", F.col("_known").isNull()).drop("_known"))
