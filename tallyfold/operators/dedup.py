"""One row per key, picked by a stated order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, types as T
from pyspark.sql import functions as F


def _tie_break(field: T.StructField) -> Column | None:
    """An ordering over the values of a column; maps order by their sorted entries."""
    column, dtype = F.col(f"`{field.name}`"), field.dataType
    if isinstance(dtype, T.MapType):
        return F.sort_array(F.map_entries(column)).asc_nulls_first()
    return None if isinstance(dtype, T.VariantType) else column.asc_nulls_first()


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = (),
                 null_keys: str = "collapse", repeated: bool = True) -> DataFrame:
    """Keep the first row of every key.

    Rows tie-break on all remaining columns, so the pick does not depend on
    how the data is laid out. ``null_keys``: ``collapse`` treats null as one
    more key value, ``keep`` keeps every row with a null key, ``drop`` none.

    ``rank = 1`` lets Spark put a group limit before the exchange: each map
    task sends at most one row per key, so a key (or null) that fills a third
    of the table costs the reducer one row per map task. Where no key has
    many rows, ``repeated=False`` saves the sort that this limit needs.
    """
    if null_keys not in ("collapse", "keep", "drop"):
        raise ValueError(f"null_keys must be collapse, keep or drop, not {null_keys!r}")
    ties = [_tie_break(f) for f in df.schema.fields if f.name not in keys]
    order = [*order_by, *[t for t in ties if t is not None]] or [F.col(k) for k in keys]
    spec = Window.partitionBy(*keys).orderBy(*order)
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    rows = df if null_keys == "collapse" else df.where(known)
    # Spark puts no limit before a count.
    rank = F.row_number().over(spec) if repeated else F.count("*").over(spec.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    picked = rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    return picked.unionByName(df.where(~known)) if null_keys == "keep" else picked


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Non-null key values that occur more than once, with their row count."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count("*").alias("occurrences")).where("occurrences > 1"))
