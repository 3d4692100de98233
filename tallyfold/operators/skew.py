"""Joins and ordered frames need help when one key holds a large part of the rows.

``heavy_keys`` measures which keys do. The measure is exact and small: a key
is heavy when it holds more than ``1 / SHARES`` of all rows, so there are fewer
than ``SHARES`` of them whatever the table size, and the list may be broadcast.
Below that share a key may have a task to itself: of 100 TB it is 1 GB at most.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, types as T
from pyspark.sql import functions as F

from ..workspace import run_dir

# A task should not get more than this part of the rows because of one key ...
SHARES = 100_000
# ... and below this many rows per key there is nothing to split.
MIN_ROWS = 1_000_000
# A key table with no more rows, and no more bytes of keys, than this is broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20


@dataclass(frozen=True)
class HeavyKeys:
    """Heavy values of one key column (null counts as a value) and the pieces each is cut into."""

    key: str
    dtype: T.DataType
    rows: tuple[tuple, ...]
    limit: float | None = None  # rows of one piece, at most

    def frame(self, df: DataFrame) -> DataFrame:
        """``_heavy_key, _pieces``; at most ``SHARES`` rows, marked for broadcast."""
        schema = T.StructType([T.StructField("_heavy_key", self.dtype, True),
                               T.StructField("_pieces", T.LongType(), False)])
        return F.broadcast(df.sparkSession.createDataFrame(list(self.rows), schema).coalesce(1))

    def __bool__(self) -> bool:
        return bool(self.rows)

    @property
    def pieces(self) -> int:
        """Pieces of all heavy keys together."""
        return sum(n for _, n in self.rows)

    @property
    def tasks(self) -> int:
        """Tasks that the rows of all heavy keys are worth: small pieces share one, up to ``MIN_ROWS`` rows."""
        share = 1.0 if self.limit is None else min(1.0, self.limit / MIN_ROWS)
        return math.ceil(self.pieces * share)


def _limit(total: Column, min_rows: int | None = None) -> Column:
    return F.greatest(F.lit(float(MIN_ROWS if min_rows is None else min_rows)), total / F.lit(SHARES))


def _pieces(rows: Column, limit: Column) -> Column:
    """Number of pieces of a heavy key, null for the others."""
    return F.when(rows > limit, F.ceil(rows / limit))


def _listed(measured: DataFrame, key: str, limit: float | None = None) -> HeavyKeys:
    """Fewer than ``SHARES`` rows reach the driver, since each stands for more than that part of the total."""
    rows = measured.where("_pieces is not null").select(key, "_pieces").collect()
    return HeavyKeys(key, measured.schema[key].dataType, tuple(tuple(r) for r in rows), limit)


def heavy_keys(df: DataFrame, key: str, shares: int | None = None, min_rows: int | None = None) -> HeavyKeys:
    """Count rows per key (one column read, combined before the shuffle) and keep the heavy ones.

    The list steers the layout, never the result. A table with too few rows for
    a heavy key is only counted, which for files means reading their footers.
    """
    total, least = df.count(), MIN_ROWS if min_rows is None else min_rows
    if total <= least:
        return HeavyKeys(key, df.schema[key].dataType, ())
    limit = max(float(least), total / (shares or SHARES))
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return _listed(counts.withColumn("_pieces", _pieces(F.col("n"), F.lit(limit))), key, limit)


@dataclass(frozen=True)
class KeyTable:
    """One row per key, written to the shared folder, so that its size is known before it is joined.

    ``heavy`` are the heavy keys of the table it was computed from.
    """

    table: DataFrame
    heavy: HeavyKeys
    small: bool


def _stored(rows: DataFrame, **seen: Column) -> tuple[DataFrame, dict]:
    """Write and read back; ``seen`` and the row count are observed while writing."""
    path, observation = run_dir(rows.sparkSession, "keys"), Observation()
    rows.observe(observation, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in seen.items()]).write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), observation.get


def _is_small(seen: Mapping, broadcast_rows: int | None) -> bool:
    most = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    return seen["rows"] <= most and (seen["bytes"] or 0) <= BROADCAST_BYTES


def _bytes(key: str) -> Column:
    return F.sum(F.octet_length(F.col(key).cast("string")).cast("long"))


def aggregate_keys(df: DataFrame, key: str, *, min_rows: int | None = None, broadcast_rows: int | None = None,
                   **aggregates: Column) -> KeyTable:
    """Aggregates of every key, computed once for joining back and for measuring skew."""
    per_key = df.groupBy(key).agg(F.count("*").alias("occurrences"), *[a.alias(n) for n, a in aggregates.items()])
    stored, seen = _stored(per_key, total=F.sum("occurrences"), largest=F.max("occurrences"), bytes=_bytes(key))
    heavy = HeavyKeys(key, stored.schema[key].dataType, ())
    limit = max(MIN_ROWS if min_rows is None else min_rows, (seen["total"] or 0) / SHARES)
    if (seen["largest"] or 0) > limit:
        heavy = _listed(stored.withColumn("_pieces", _pieces(F.col("occurrences"), F.lit(float(limit)))), key)
    return KeyTable(stored, heavy, _is_small(seen, broadcast_rows))


def flagged_keys(df: DataFrame, key: str, flag: Callable[[DataFrame], DataFrame], *, min_rows: int | None = None,
                 broadcast_rows: int | None = None) -> KeyTable:
    """Keys picked by ``flag``, which gets ``key, occurrences`` and adds a boolean ``_flag``; null is never picked.

    Rows are counted per key before anything else, so a key with very many
    rows crosses the network once per map task.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("occurrences"))
    total = counts.agg(F.sum("occurrences").alias("total")).scalar()
    marked = flag(counts).withColumns({
        "_flag": F.col("_flag") & F.col(key).isNotNull(),
        "_pieces": _pieces(F.col("occurrences"), _limit(total, min_rows=min_rows)),
    })
    stored, seen = _stored(marked.where("_flag or _pieces is not null"), heavy=F.count("_pieces"), bytes=_bytes(key))
    heavy = _listed(stored, key) if seen["heavy"] else HeavyKeys(key, stored.schema[key].dataType, ())
    return KeyTable(stored.where("_flag").select(key, "occurrences"), heavy, _is_small(seen, broadcast_rows))


def _tagged(df: DataFrame, heavy: HeavyKeys) -> DataFrame:
    marks = heavy.frame(df)
    return df.join(marks, F.col(heavy.key).eqNullSafe(marks["_heavy_key"]), "left").drop("_heavy_key")


def salted_left_join(left: DataFrame, right: DataFrame, heavy: HeavyKeys, spread_by: Column) -> DataFrame:
    """Left outer join on ``heavy.key`` with heavy keys cut into pieces.

    Left rows of a heavy key go to one of its pieces by ``spread_by`` (a hash
    of something that differs between rows, so a retried task sends the same
    rows the same way); right rows of that key are repeated once per piece.
    All pieces together number less than twice ``SHARES``. Null is cut like any
    heavy key, and finds no partner.
    """
    key = heavy.key
    if not heavy:
        return left.join(right, key, "left")
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    left = _tagged(left, heavy).withColumn("_piece", F.pmod(spread_by, pieces)).drop("_pieces")
    right = (_tagged(right.where(F.col(key).isNotNull()), heavy)
             .withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("_pieces"))
    return left.join(right, [key, "_piece"], "left").drop("_piece")


def lookup_left_join(left: DataFrame, right: KeyTable) -> DataFrame:
    """Left outer join with a table of keys.

    A small key table is broadcast. Otherwise rows of heavy keys still do not
    travel: the right rows of those keys are fewer than ``SHARES`` and are
    broadcast to where they are, while all other rows take an ordinary join.
    Nothing depends on a hash spreading the rows of a key, so exact copies do no harm.
    """
    key = right.heavy.key
    if right.small:
        return left.join(F.broadcast(right.table), key, "left")
    if not right.heavy:
        return left.join(right.table, key, "left")
    tagged = _tagged(left, right.heavy)
    marks = right.heavy.frame(left)
    of_heavy = F.broadcast(right.table.join(marks, F.col(key) == marks["_heavy_key"], "left_semi"))
    hot = tagged.where("_pieces is not null").drop("_pieces").join(of_heavy, key, "left")
    cold = tagged.where("_pieces is null").drop("_pieces").join(right.table, key, "left")
    return cold.unionByName(hot)
