"""Window features, anomaly flags, row frames, run metrics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.alerts import BATCH_LIMITS, STREAM_LIMITS, AnomalyLimits
from ..operators.features import flag_anomalies, window_features
from ..operators.metrics import error_counts, freshness, metric_rows, run_metrics
from ..operators.ordered import moving_average, zscore_history, zscore_previous
from ..operators.skew import heavy_keys
from ..operators.clean import clean_customers, clean_transactions
from ..sinks.audit import within_retention
from .batch import newest_first
from .tables import CRM_CTES, STREAM_CTE, TX_CTES, crm_raw, table, tx_raw, tx_stream

ORDER = ("event_ts", "transaction_id")
AS_OF = datetime(2024, 2, 1)
SCALED = AnomalyLimits(average=100.0, count=8, stddev=100.0)


def rounded(df, *names):
    """The engines differ in the last bits of averages and deviations."""
    return df.withColumns({n: F.round(n, 6) for n in names})


def features(spark, sf_dir, window, slide):
    return rounded(window_features(tx_stream(spark, sf_dir), window, slide, event_time="event_ts"),
                   "rolling_avg_amount", "stddev_amount")


def order_features(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_id"),
                                                   F.col("o_totalprice").alias("amount"), "o_orderdate")
    return window_features(orders, event_time="o_orderdate")


def flagged(df, limits):
    return rounded(flag_anomalies(df, limits), "rolling_avg_amount", "stddev_amount")


def split_moving_average(spark, sf_dir):
    """The same frames with customers cut into runs from a few rows on."""
    tx = tx_stream(spark, sf_dir)
    return moving_average(tx, 5, order_by=ORDER, heavy=heavy_keys(tx, "customer_id", min_rows=20))


def split_zscore(spark, sf_dir):
    tx = tx_stream(spark, sf_dir)
    return zscore_previous(tx, order_by=ORDER, heavy=heavy_keys(tx, "customer_id", min_rows=20))


def event_batches(spark, sf_dir):
    """Events of one kind on one day, taken as one processing run."""
    return (table(spark, sf_dir, "events")
            .groupBy(F.col("event_type").alias("pipeline"), F.date_format("ts", "yyyyMMdd").cast("bigint").alias("batch_id"))
            .agg(F.min("ts").alias("started"), F.max("ts").alias("finished"), F.count("*").alias("records")))


def event_errors(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("pipeline"),
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"))
    return error_counts(events, limit=15)


def order_loads(spark, sf_dir):
    """One load per order day, kept for 30 days."""
    log = (table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").alias("finished"))
           .agg(F.count("*").alias("rows"))
           .select(F.date_format("finished", "yyyyMMdd").alias("load_id"), "rows", "finished"))
    return within_retention(log, F.lit("2001-07-31 00:00:00").cast("timestamp_ntz"))


def volumes(spark, sf_dir):
    tx = clean_transactions(tx_raw(spark, sf_dir), newest_first()).agg(
        F.count("*").alias("transactions"), F.count_if("is_valid").alias("valid_transactions"),
        F.count_if(F.col("customer_id").isNull()).alias("transactions_without_customer"))
    crm = clean_customers(crm_raw(spark, sf_dir), newest_first()).agg(
        F.count("*").alias("customers"), F.sum("is_active").alias("active_customers"))
    return metric_rows(tx).unionByName(metric_rows(crm))


QUERIES = {
    "window_features": lambda spark, sf_dir: features(spark, sf_dir, "10 minutes", "5 minutes"),
    "window_features_tumbling": lambda spark, sf_dir: features(spark, sf_dir, "1 hour", "1 hour"),
    "anomaly_default": lambda spark, sf_dir: flagged(order_features(spark, sf_dir), BATCH_LIMITS),
    "anomaly_stream_rule": lambda spark, sf_dir: flagged(order_features(spark, sf_dir), STREAM_LIMITS),
    "anomaly_scaled": lambda spark, sf_dir: flagged(
        window_features(tx_stream(spark, sf_dir), "1 day", "12 hours", event_time="event_ts"), SCALED),
    "moving_average_5": lambda spark, sf_dir: rounded(
        moving_average(tx_stream(spark, sf_dir), 5, order_by=ORDER), "moving_avg_amount"),
    "zscore_history": lambda spark, sf_dir: rounded(
        zscore_history(tx_stream(spark, sf_dir)), "baseline_avg", "baseline_stddev", "z_score"),
    "zscore_history_large": lambda spark, sf_dir: rounded(
        zscore_history(tx_stream(spark, sf_dir), min_rows=20, broadcast_rows=0), "baseline_avg", "baseline_stddev", "z_score"),
    "zscore_prev5": lambda spark, sf_dir: rounded(
        zscore_previous(tx_stream(spark, sf_dir), order_by=ORDER), "baseline_avg", "baseline_stddev", "z_score"),
    "moving_average_5_split": lambda spark, sf_dir: rounded(split_moving_average(spark, sf_dir), "moving_avg_amount"),
    "zscore_prev5_split": lambda spark, sf_dir: rounded(
        split_zscore(spark, sf_dir), "baseline_avg", "baseline_stddev", "z_score"),
    "run_metrics": lambda spark, sf_dir: run_metrics(event_batches(spark, sf_dir), latency_limit=80000.0),
    "error_alerts": event_errors,
    "source_freshness": lambda spark, sf_dir: freshness(
        {name: (table(spark, sf_dir, name), column) for name, column in
         (("orders", "o_orderdate"), ("events", "ts"), ("lineitem", "l_shipdate"))}, AS_OF),
    "volume_metrics": volumes,
    "load_audit": order_loads,
}


def window_sql(source, ts, customer, amount, size, slide, copies):
    return f"""SELECT w AS window_start, w + INTERVAL '{size}' AS window_end, {customer} AS customer_id,
        round(avg({amount}), 6) AS rolling_avg_amount, round(stddev_samp({amount}), 6) AS stddev_amount,
        count(*) AS transaction_count
      FROM (SELECT *, time_bucket(INTERVAL '{slide}', {ts}) - k * INTERVAL '{slide}' AS w
            FROM {source}, range({copies}) r(k)) GROUP BY w, {customer}"""


def flag_sql(features_sql, condition):
    return f"SELECT *, CASE WHEN {condition} THEN 1 ELSE 0 END AS anomaly_flag FROM ({features_sql})"


_EVENTS_10_5 = f"WITH {STREAM_CTE} " + window_sql("tx_stream", "event_ts", "customer_id", "amount", "10 minutes", "5 minutes", 2)
_ORDERS_10_5 = window_sql("orders", "o_orderdate", "o_custkey", "o_totalprice", "10 minutes", "5 minutes", 2)


def zscore_sql(window):
    return f"""WITH {STREAM_CTE}, framed AS (
        SELECT *, avg(amount) OVER w AS a, stddev_samp(amount) OVER w AS s FROM tx_stream WINDOW w AS ({window}))
      SELECT transaction_id, customer_id, amount, event_ts, round(a, 6) AS baseline_avg, round(s, 6) AS baseline_stddev,
        CASE WHEN s > 0 THEN round((amount - a) / s, 6) END AS z_score,
        CASE WHEN s > 0 AND abs(amount - a) > 2.5 * s THEN 1 ELSE 0 END AS z_flag FROM framed"""


ORACLES = {
    "window_features": _EVENTS_10_5,
    "window_features_tumbling": f"WITH {STREAM_CTE} " + window_sql(
        "tx_stream", "event_ts", "customer_id", "amount", "1 hour", "1 hour", 1),
    "anomaly_default": flag_sql(_ORDERS_10_5, "rolling_avg_amount > 10000 OR transaction_count > 50 OR stddev_amount > 5000"),
    "anomaly_stream_rule": flag_sql(_ORDERS_10_5, "rolling_avg_amount > 10000 OR transaction_count > 50"),
    "anomaly_scaled": f"WITH {STREAM_CTE} " + flag_sql(
        window_sql("tx_stream", "event_ts", "customer_id", "amount", "1 day", "12 hours", 2),
        "rolling_avg_amount > 100 OR transaction_count > 8 OR stddev_amount > 100"),
    "moving_average_5": f"""WITH {STREAM_CTE} SELECT *, round(avg(amount) OVER (PARTITION BY customer_id
        ORDER BY event_ts NULLS FIRST, transaction_id NULLS FIRST ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6)
        AS moving_avg_amount FROM tx_stream""",
    "zscore_history": zscore_sql("PARTITION BY customer_id"),
    # Heavy customers apart and no key table small enough to broadcast, as on a large table.
    "zscore_history_large": zscore_sql("PARTITION BY customer_id"),
    "zscore_prev5": zscore_sql("PARTITION BY customer_id ORDER BY event_ts NULLS FIRST, transaction_id NULLS FIRST "
                               "ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING"),
    "run_metrics": """WITH b AS (
        SELECT event_type AS pipeline, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS batch_id, min(ts) AS started,
          max(ts) AS finished, count(*) AS records FROM events GROUP BY ALL),
      d AS (SELECT *, (epoch_us(finished) - epoch_us(started)) / 1e6 AS s FROM b)
      SELECT pipeline, batch_id, started, finished, records, round(s, 3) AS latency_seconds,
        CASE WHEN s > 0 THEN round(records / s, 2) ELSE 0.0 END AS records_per_second,
        round(s, 3) <> 0 AND round(s, 3) > 80000 AS latency_alert FROM d""",
    "error_alerts": """SELECT CAST(user_id AS VARCHAR) AS pipeline, count(*) FILTER (event_type = 'error') AS errors,
        count(*) FILTER (event_type = 'error') >= 15 AS error_alert FROM events GROUP BY user_id""",
    "source_freshness": """SELECT *, date_sub('second', newest, TIMESTAMP '2024-02-01') AS lag_seconds FROM (
        SELECT 'orders' AS source, max(o_orderdate) AS newest FROM orders UNION ALL
        SELECT 'events', max(ts) FROM events UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem)""",
    "volume_metrics": f"""WITH {CRM_CTES}, {TX_CTES}
        SELECT 'transactions' AS metric, CAST(count(*) AS DOUBLE) AS value FROM tx_clean
        UNION ALL SELECT 'valid_transactions', count(*) FILTER (is_valid) FROM tx_clean
        UNION ALL SELECT 'transactions_without_customer', count(*) FILTER (customer_id IS NULL) FROM tx_clean
        UNION ALL SELECT 'customers', count(*) FROM crm_clean
        UNION ALL SELECT 'active_customers', sum(is_active) FROM crm_clean""",
    "load_audit": """SELECT strftime(o_orderdate, '%Y%m%d') AS load_id, count(*) AS rows, o_orderdate AS finished
        FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-31' - INTERVAL 30 DAY GROUP BY o_orderdate""",
}
ORACLES["moving_average_5_split"] = ORACLES["moving_average_5"]
ORACLES["zscore_prev5_split"] = ORACLES["zscore_prev5"]
