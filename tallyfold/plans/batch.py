"""Daily job: clean, join, store by date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.clean import clean_customers, clean_transactions
from ..operators.enrich import KEY, join_customers
from ..operators.skew import HeavyKeys, heavy_keys
from ..settings import SHUFFLED_PER_STORED, TASK_BYTES, input_bytes, sized_for
from ..sinks.layout import save_partitioned
from ..workspace import scratch


def joined_transactions(transactions: DataFrame, customers: DataFrame, *, run_ts: datetime | None = None,
                        latest_first: Sequence[Column] = (), heavy: HeavyKeys | None = None) -> DataFrame:
    """Cleaned, deduplicated transactions with their customers.

    Skew is measured on the raw key column: cleaning does not change it, and
    one column is cheaper to read than the deduplicated table.
    """
    if heavy is None:
        heavy = heavy_keys(transactions, KEY)
    return join_customers(clean_transactions(transactions, latest_first), clean_customers(customers, latest_first),
                          run_ts=run_ts, heavy=heavy)


def run_batch(transactions: DataFrame, customers: DataFrame, path: str, *, run_ts: datetime | None = None,
              latest_first: Sequence[Column] = (), monthly: bool = False) -> int:
    """Store the joined table by transaction day in one pass; return its row count.

    ``monthly`` adds ``transaction_month`` and stores by that, for loads of a
    long history with few rows a day. Shuffles are sized by the input; intermediate folders are deleted.
    """
    with sized_for(transactions, customers), scratch(transactions.sparkSession):
        joined = joined_transactions(transactions, customers, run_ts=run_ts, latest_first=latest_first)
        if not monthly:
            # The join keeps one row per transaction, so what is stored is about as large as what is read.
            stored = SHUFFLED_PER_STORED * input_bytes(transactions, customers, unknown=TASK_BYTES)
            return save_partitioned(joined, path, small=stored <= TASK_BYTES)
        month = F.trunc("transaction_date", "month")
        return save_partitioned(joined.withColumn("transaction_month", month), path, "transaction_month",
                                ("customer_id", "transaction_date"))
