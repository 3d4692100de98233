"""Moving average on a stream, where Spark has no row frames.

Two forms of the same thing. ``moving_average_stream`` keeps its state in the
state store and suits short triggers with little input each.
``start_moving_average`` works micro-batch by micro-batch with the table
operator and suits large ones, such as catching up on a backlog: a customer
with very many rows is cut as on a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.ordered import usable, with_row_frame
from ..sinks.keyed_log import KeyedLog
from .epochs import batch_folder, epoch_of
from .parse import triggered


def _sorted(rows, order: Sequence[str]):
    """A pandas frame by ``order``, nulls first. Where the first column decides alone, as times mostly do, it is the only one sorted by:
    a sort by several columns costs milliseconds however few the rows, and is paid per customer and micro-batch."""
    import numpy as np

    first = rows[order[0]].to_numpy()
    if first.dtype.kind == "i" or (first.dtype.kind == "M" and not np.isnat(first).any()):
        places = np.argsort(first, kind="stable")
        ranked = first[places]
        if (ranked[1:] != ranked[:-1]).all():
            return rows.take(places)
    return rows.sort_values([*order], kind="stable", na_position="first")


def moving_average_stream(transactions: DataFrame, rows: int = 5, *, key: str = "customer_id", amount: str = "amount",
                          order_by: Sequence[str] = ("timestamp", "transaction_id")) -> DataFrame:
    """Each transaction with ``moving_avg_amount`` over it and the ``rows - 1`` before it.

    State is the last ``rows - 1`` amounts of a customer. Within a micro-batch
    rows are put in order; across micro-batches they count in order of
    arrival, so the result equals the batch one when files or offsets are read
    in time order. NaN counts as missing, and ties of ``order_by`` are broken by
    the amount, as in the table form. All rows a customer has in one micro-batch meet in one
    task: cap the source (``maxOffsetsPerTrigger``, ``maxBytesPerTrigger``).
    """
    output = T.StructType([*transactions.schema.fields, T.StructField("moving_avg_amount", T.DoubleType())])
    state_schema = T.StructType([T.StructField("last", T.ArrayType(T.DoubleType()))])
    names, order, reach = list(transactions.columns), list(order_by), rows - 1

    def advance(_, chunks, state):
        import numpy as np
        import pandas as pd

        chunks = list(chunks)
        batch = chunks[0] if len(chunks) == 1 else pd.concat(chunks, ignore_index=True)
        if len(batch) > 1:
            batch = _sorted(batch, [*order, amount])
        before = [np.nan if v is None else v for v in state.get[0]] if state.exists else []
        seen = np.concatenate([np.full(reach - len(before), np.nan), before, batch[amount].to_numpy(float)])
        frames = np.lib.stride_tricks.sliding_window_view(seen, rows)
        counts = (~np.isnan(frames)).sum(axis=1)
        with np.errstate(invalid="ignore"):
            batch["moving_avg_amount"] = np.nansum(frames, axis=1) / np.where(counts > 0, counts, np.nan)
        kept = seen[len(seen) - reach:] if reach else seen[:0]
        state.update(([None if np.isnan(v) else float(v) for v in kept],))
        yield batch if list(batch.columns) == [*names, "moving_avg_amount"] else batch[[*names, "moving_avg_amount"]]

    return transactions.groupBy(key).applyInPandasWithState(
        advance, output, state_schema, "append", GroupStateTimeout.NoTimeout)


def last_rows_log(path: str, transactions: DataFrame, *, key: str = "customer_id", amount: str = "amount",
                  order_by: Sequence[str] = ("timestamp", "transaction_id")) -> KeyedLog:
    """Log of the last rows of every customer; ``_place`` -1 is the newest."""
    kept = [T.StructField("_place", T.IntegerType()), *[transactions.schema[c] for c in (*order_by, amount)]]
    last = T.StructField("_last", T.ArrayType(T.StructType(kept)))
    return KeyedLog(path, [key], T.StructType([transactions.schema[key], last]))


def start_moving_average(transactions: DataFrame, path: str, log: KeyedLog, checkpoint: str, rows: int = 5, *,
                         key: str = "customer_id", amount: str = "amount",
                         order_by: Sequence[str] = ("timestamp", "transaction_id"),
                         every: str | None = "5 seconds") -> StreamingQuery:
    """Write each transaction with ``moving_avg_amount`` under ``path``, one folder per micro-batch.

    Rows count in order within a micro-batch and in order of arrival across
    them. A replayed micro-batch sees the log as it was and replaces its folders; a query with another checkpoint
    goes on from the last rows of the ones before.
    """
    epoch = epoch_of(transactions.sparkSession, checkpoint, path)
    in_order = ["_place", *order_by]
    newest_first = Window.partitionBy(key).orderBy(*[F.col(c).desc_nulls_last() for c in (*in_order, amount)])

    def advance(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            seen = batch.select(F.col(key).alias("_seen")).distinct()
            earlier = (log.current(batch.sparkSession, before=(epoch, batch_id), only=seen)
                       .select(key, F.inline("_last")))
            both = batch.withColumn("_place", F.lit(0)).unionByName(earlier, allowMissingColumns=True)
            framed = with_row_frame(both, key, in_order, [amount], (1 - rows, 0),
                                    lambda w: {"moving_avg_amount": F.avg(usable(amount)).over(w)})
            framed.where("_place = 0").drop("_place").write.mode("overwrite").parquet(
                batch_folder(path, epoch, batch_id))
            last = both.withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") < rows)
            kept = F.struct((-F.col("_rank")).alias("_place"), *order_by, amount)
            log.write(last.groupBy(key).agg(F.sort_array(F.collect_list(kept)).alias("_last")),
                      batch_id, epoch)
        finally:
            batch.unpersist()

    log.create(transactions.sparkSession)
    return triggered(transactions.writeStream.foreachBatch(advance).option("checkpointLocation", checkpoint), every).start()
