"""Row-by-row results that depend on all earlier rows of a customer, kept in the state store.

State is small and of fixed size per customer: moments (count, mean, sum of squared distances) for the z-score, the last amounts
for the moving average. It can begin with what a table says, and can be dropped for customers that stay away.

Start these queries inside ``state_settings(spark, on_disk=True)``: this kind of state lives in RocksDB. Rows of a micro-batch are
put in order per customer, across micro-batches they count in order of arrival. A customer's rows of one
micro-batch meet in one task, so cap the source; backlogs suit ``moving.start_moving_average``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.ordered import scored, usable

ORDER = ("timestamp", "transaction_id")
MOMENTS = T.StructType([T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType()), T.StructField("m2", T.DoubleType())])


def history_moments(history: DataFrame, *, key: str = "customer_id", amount: str = "amount") -> DataFrame:
    """Per customer the moments that a stream over the rows of ``history`` would leave behind."""
    value = usable(amount)
    return history.groupBy(key).agg(F.count(value).alias("n"), F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"),
                                    F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias("m2"))


def _in_order(names: Sequence[str]) -> Callable[[Row], tuple]:
    """Nulls first."""
    return lambda row: tuple((row[n] is not None, row[n]) for n in names)


class _Moments(StatefulProcessor):
    def __init__(self, output: Sequence[str], order: Sequence[str], amount: str, idle_ms: int | None):
        self.output, self.order, self.amount, self.idle_ms = tuple(output), tuple(order), amount, idle_ms

    def init(self, handle) -> None:
        self.state = handle.getValueState("moments", MOMENTS, self.idle_ms)

    def handleInitialState(self, key, initial, timers) -> None:
        self.state.update((initial["n"], initial["mean"], initial["m2"]))

    def handleInputRows(self, key, rows, timers) -> Iterator[Row]:
        n, mean, m2 = self.state.get() if self.state.exists() else (0, 0.0, 0.0)
        judged = Row(*self.output)
        for row in sorted(rows, key=_in_order((*self.order, self.amount))):
            yield judged(*row, mean if n else None, math.sqrt(m2 / (n - 1)) if n > 1 else None)
            value = row[self.amount]
            if value is not None and not math.isnan(value):
                n += 1
                step = value - mean
                mean += step / n
                m2 += step * (value - mean)
        self.state.update((n, mean, m2))

    def close(self) -> None:
        pass


class _LastAmounts(StatefulProcessor):
    def __init__(self, output: Sequence[str], order: Sequence[str], amount: str, idle_ms: int | None, rows: int):
        self.output, self.order, self.amount, self.idle_ms, self.rows = tuple(output), tuple(order), amount, idle_ms, rows

    def init(self, handle) -> None:
        self.state = handle.getListState("amounts", T.StructType([T.StructField("amount", T.DoubleType())]), self.idle_ms)

    def handleInitialState(self, key, initial, timers) -> None:
        self.state.put([(v,) for v in initial["amounts"][1 - self.rows:]])

    def handleInputRows(self, key, rows, timers) -> Iterator[Row]:
        last = [v for v, in self.state.get()] if self.rows > 1 else []
        averaged = Row(*self.output)
        for row in sorted(rows, key=_in_order((*self.order, self.amount))):
            value = row[self.amount]
            last = [*last, None if value is None or math.isnan(value) else value][-self.rows:]
            known = [v for v in last if v is not None]
            yield averaged(*row, math.fsum(known) / len(known) if known else None)
        if kept := last[1:] if len(last) == self.rows else last:
            self.state.put([(v,) for v in kept])

    def close(self) -> None:
        pass


def _applied(transactions: DataFrame, processor: Callable[..., StatefulProcessor], added: Sequence[str], key: str, order_by: Sequence[str],
             amount: str, initial: DataFrame | None, idle_ms: int | None, *settings) -> DataFrame:
    output = T.StructType([*transactions.schema.fields, *[T.StructField(name, T.DoubleType()) for name in added]])
    return transactions.groupBy(key).transformWithState(
        processor(output.names, order_by, amount, idle_ms, *settings), output, "Append",
        "None" if idle_ms is None else "ProcessingTime", None if initial is None else initial.groupBy(key))


def zscore_stream(transactions: DataFrame, threshold: float = 2.5, *, key: str = "customer_id", amount: str = "amount",
                  order_by: Sequence[str] = ORDER, initial: DataFrame | None = None, idle_ms: int | None = None) -> DataFrame:
    """Each transaction with ``z_score`` and ``z_flag`` against all the customer's transactions before it.

    ``initial`` has a customer's ``n, mean, m2`` (see ``history_moments``). NaN counts as missing; a first or second amount has
    no deviation to be measured by. Customers without rows for ``idle_ms`` begin anew; give such a query an interval trigger, as
    one that runs over what is there now waits for times to pass and does not end.
    """
    judged = _applied(transactions, _Moments, ("baseline_avg", "baseline_stddev"), key, order_by, amount, initial, idle_ms)
    return scored(judged, amount, threshold)


def moving_average_state(transactions: DataFrame, rows: int = 5, *, key: str = "customer_id", amount: str = "amount",
                         order_by: Sequence[str] = ORDER, initial: DataFrame | None = None, idle_ms: int | None = None) -> DataFrame:
    """Each transaction with ``moving_avg_amount`` over it and the ``rows - 1`` before it.

    ``initial`` has a customer's last ``amounts`` as an array, oldest first.
    """
    return _applied(transactions, _LastAmounts, ("moving_avg_amount",), key, order_by, amount, initial, idle_ms, rows)
