"""Streams judged row by row: scores against history, late rows, rules with counters. Windows by panes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.alerts import AnomalyLimits
from ..operators.clean import standardise_transactions
from ..operators.features import flag_anomalies
from ..operators.panes import micros, pane_window_features, pane_window_runs
from ..quality.report import suite_statistics
from ..quality.rules import CRM_SUITE, TRANSACTION_SUITE, Rule
from ..quality.suite import run_suite
from ..sinks.audit import TooManyBadRecords, save_within_limit
from ..sources.files import start_validation_results
from ..streaming.features import FeatureSettings, start_appends, state_settings
from ..streaming.gate import COUNTERS, rejection_alerts, start_gate
from ..streaming.late import start_late_split
from ..streaming.progress import ProgressLog
from ..streaming.stateful import history_moments, moving_average_state, zscore_stream
from ..workspace import run_dir
from .features import ORACLES as TABLE_ORACLES, rounded
from .quality import STATISTICS, crm, tx
from .streaming import SLICED, SLICES, Feed, transactions, without_zone
from .tables import STREAM_CTE, TX_CTES, tx_raw, tx_stream

SCORES = ("baseline_avg", "baseline_stddev", "z_score")
DAY_LIMITS = AnomalyLimits(average=60.0, count=6, stddev=55.0)
RULES = (
    Rule("not_null", "customer_id"),
    Rule("between", "amount", low=0.5, high=200.0),
    Rule("matches_regex", "transaction_id", pattern="E[0-9]*[0-8]$", severity="warning"),
)
REJECTION_LIMIT = 20


def _run(rows, out, checkpoint):
    with state_settings(rows.sparkSession, on_disk=True):
        start_appends(rows, out, checkpoint, every=None).awaitTermination()


def _scored_rows(written):
    # Means of cents over 32 rows end half-way between two sixth digits, so nine are kept.
    return without_zone(written, "timestamp").withColumns({n: F.round(n, 9) for n in SCORES}).withColumnRenamed("timestamp", "event_ts")


def zscores(spark, sf_dir):
    """Five micro-batches, with a stop and a restart from the checkpoint after the third."""
    feed, out, checkpoint = Feed(spark, sf_dir).add(0, 1, 2), run_dir(spark, "zscores"), run_dir(spark, "zscores-checkpoint")
    rows = zscore_stream(feed.transactions())
    _run(rows, out, checkpoint)
    feed.add(3, 4)
    _run(rows, out, checkpoint)
    return _scored_rows(spark.read.schema(rows.schema).parquet(out))


def zscores_after_history(spark, sf_dir):
    """The last two slices as a stream whose state begins with the moments of the first three, taken from a table."""
    feed = Feed(spark, sf_dir).add(3, 4)
    # The same view of the same events as in the stream, as a table.
    earlier = feed.slices.where("_slice < 3").select(F.col("user_id").cast("string").alias("customer_id"), F.col("value").alias("amount"))
    rows = zscore_stream(feed.transactions(), initial=history_moments(earlier))
    out = run_dir(spark, "zscores")
    _run(rows, out, run_dir(spark, "zscores-checkpoint"))
    return _scored_rows(spark.read.schema(rows.schema).parquet(out))


def moving_average_by_state(spark, sf_dir):
    rows = moving_average_state(transactions(spark, sf_dir))
    out = run_dir(spark, "moving-average")
    _run(rows, out, run_dir(spark, "moving-average-checkpoint"))
    written = spark.read.schema(rows.schema).parquet(out)
    return rounded(without_zone(written, "timestamp"), "moving_avg_amount").withColumnRenamed("timestamp", "event_ts")


def late_rows_kept(spark, sf_dir):
    """Slice 1 arrives after slices 2 and 3. Both halves together are all rows, each with the windows it came too late for."""
    accepted, late = run_dir(spark, "accepted"), run_dir(spark, "late")
    start_late_split(Feed(spark, sf_dir).add(0, 2, 3, 1, 4).transactions(), accepted, late, run_dir(spark, "watermarks"),
                     run_dir(spark, "late-checkpoint"), FeatureSettings("1 day", "12 hours", watermark="1 hour"), every=None).awaitTermination()
    halves = spark.read.parquet(accepted).withColumn("reason", F.lit("in time")).unionByName(spark.read.parquet(late), allowMissingColumns=True)
    return halves.select("transaction_id", F.col("timestamp").cast("timestamp_ntz").alias("event_ts"), "closed_windows", "reason")


def _gate(spark, sf_dir):
    out = run_dir(spark, "gate")
    log = ProgressLog(spark, run_dir(spark, "gate-log"), "events", counters=run_dir(spark, "gate-counters")).start()
    try:
        log.wait(start_gate(transactions(spark, sf_dir), RULES, out, run_dir(spark, "gate-checkpoint"), every=None))
    finally:
        log.stop()
    return spark.read.parquet(out), log.counters()


def gate_rows(spark, sf_dir):
    """Every row, with whether the gate let it pass and what it failed."""
    rows, _ = _gate(spark, sf_dir)
    # A folder name comes back as text.
    return rows.select("transaction_id", F.col("accepted").cast("boolean").alias("accepted"), F.array_join(F.array_sort("failed_rules"), ",").alias("failed_rules"))


def gate_counters(spark, sf_dir):
    """What the micro-batches counted while their rows passed, and the alerts on rejections."""
    _, counters = _gate(spark, sf_dir)
    alerts = rejection_alerts(counters, REJECTION_LIMIT).select("batch_id", F.lit("alert").alias("name"), F.col("alert").cast("bigint").alias("value"))
    return counters.where(F.col("observed") == COUNTERS).select("batch_id", "name", "value").unionByName(alerts)


def day_by_minute(spark, sf_dir):
    """Windows of 24 hours that start every minute, 1440 to a row, summed up per customer."""
    runs = pane_window_runs(tx_stream(spark, sf_dir), "24 hours", "1 minute", event_time="event_ts")
    windows = (F.col("last_start") - F.col("first_start")) / F.lit(micros("1 minute")) + 1
    flagged = flag_anomalies(runs, DAY_LIMITS).withColumn("_windows", windows.cast("long"))
    return rounded(flagged.groupBy("customer_id").agg(
        F.sum("_windows").alias("windows"), F.sum(F.col("_windows") * F.col("anomaly_flag")).alias("flagged_windows"),
        F.sum(F.col("_windows") * F.col("transaction_count")).alias("rows_in_windows"), F.max("transaction_count").alias("most_rows"),
        F.max("rolling_avg_amount").alias("highest_avg"), F.max("stddev_amount").alias("highest_stddev")), "highest_avg", "highest_stddev")


def results_by_file(spark, sf_dir):
    """Results of one suite, then of another: the second run reads only the file that came after the first run."""
    root, out, checkpoint = run_dir(spark, "validations"), run_dir(spark, "results"), run_dir(spark, "results-checkpoint")
    counts = [0]
    for name, rules, rows in (("crm", CRM_SUITE, crm), ("transactions", TRANSACTION_SUITE, tx)):
        stats = suite_statistics(run_suite(rows(spark, sf_dir), name, rules))
        fields = [c for c in stats.columns if c != "suite"]
        (stats.select(F.struct(F.col("suite").alias("expectation_suite_name")).alias("meta"), F.struct(*fields).alias("statistics"))
         .coalesce(1).write.json(f"{root}/{name}/latest"))
        start_validation_results(spark, root, out, checkpoint, every=None).awaitTermination()
        counts.append(spark.read.parquet(out).count())
    new = [b - a for a, b in zip(counts, counts[1:])]
    return spark.read.parquet(out).drop("file").withColumn("rows_of_its_run", F.when(F.col("suite") == "crm", new[0]).otherwise(new[1]))


def load_within_limit(spark, sf_dir):
    """Three loads into one table: refused for its bad rows, accepted, and accepted in place of what is there."""
    path, rows = run_dir(spark, "limited"), standardise_transactions(tx_raw(spark, sf_dir))
    bad, outcome = ~F.col("is_valid"), []
    for limit, mode in ((0, "append"), (1 << 40, "append"), (1 << 40, "overwrite")):
        try:
            outcome.append(save_within_limit(rows, bad, path, limit, mode))
        except TooManyBadRecords:
            outcome.append(None)
    written = spark.read.parquet(path).drop("load").withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))
    return written.withColumns({f"load_{i}": F.lit(n).cast("bigint") for i, n in enumerate(outcome, 1)})


QUERIES = {
    "validation_results_by_file": results_by_file,
    "load_within_limit": load_within_limit,
    "stream_zscore_history": zscores,
    "stream_zscore_after_history": zscores_after_history,
    "stream_moving_average_5_by_state": moving_average_by_state,
    "stream_late_rows_kept": late_rows_kept,
    "stream_gate": gate_rows,
    "stream_gate_counters": gate_counters,
    "window_features_panes": lambda spark, sf_dir: rounded(
        pane_window_features(tx_stream(spark, sf_dir), event_time="event_ts"), "rolling_avg_amount", "stddev_amount"),
    "window_features_day_by_minute": day_by_minute,
}

_PREVIOUS = "PARTITION BY customer_id ORDER BY event_ts, transaction_id, amount ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
_ZSCORES = f"""WITH {STREAM_CTE}, b AS (
    SELECT *, avg(amount) OVER w AS m, stddev_samp(amount) OVER w AS d FROM tx_stream WINDOW w AS ({_PREVIOUS}))
  SELECT transaction_id, customer_id, amount, event_ts, round(m, 9) AS baseline_avg, round(d, 9) AS baseline_stddev,
    round(CASE WHEN d > 0 THEN (amount - m) / d END, 9) AS z_score,
    CASE WHEN d > 0 AND abs(amount - m) > 2.5 * d THEN 1 ELSE 0 END AS z_flag FROM b"""
_JUDGED = f"""SELECT 'E' || CAST(event_id AS VARCHAR) AS transaction_id, s AS batch_id, NOT coalesce(value BETWEEN 0.5 AND 200, true) AS bad_amount,
    user_id IS NULL AS no_customer, event_id % 10 = 9 AS bad_id FROM ({SLICED})"""
_COUNTS = f"""SELECT batch_id, count(*) AS n, count(*) FILTER (NOT bad_amount AND NOT no_customer) AS ok,
    count(*) FILTER (bad_amount OR no_customer) AS bad, count(*) FILTER (no_customer) AS c, count(*) FILTER (bad_amount) AS a,
    count(*) FILTER (bad_id) AS t FROM ({_JUDGED}) GROUP BY batch_id"""
# Watermarks of the micro-batches that read slices 0, 2, 3, 1, 4 in this order.
_LATE = f"""WITH e AS ({SLICED}), latest AS (SELECT s, epoch_us(max(ts)) AS m FROM e GROUP BY s),
  marks AS (SELECT s, (CASE s WHEN 2 THEN (SELECT m FROM latest WHERE s = 0) WHEN 3 THEN (SELECT m FROM latest WHERE s = 2)
      WHEN 1 THEN (SELECT m FROM latest WHERE s = 3) WHEN 4 THEN (SELECT m FROM latest WHERE s = 3) END - 3600000000) // 1000 * 1000 AS mark FROM latest),
  c AS (SELECT event_id, ts, (epoch_us(ts) // 43200000000) * 43200000000 AS newest, mark FROM e JOIN marks USING (s)),
  n AS (SELECT *, CAST(coalesce(newest + 86400000000 <= mark, false) AS INTEGER) + CAST(coalesce(newest + 43200000000 <= mark, false) AS INTEGER) AS closed FROM c)
  SELECT 'E' || CAST(event_id AS VARCHAR) AS transaction_id, ts AS event_ts, closed AS closed_windows,
    CASE WHEN closed = 2 THEN 'late' ELSE 'in time' END AS reason FROM n"""

ORACLES = {
    "validation_results_by_file": f"{STATISTICS} SELECT *, 1 AS rows_of_its_run FROM statistics",
    "load_within_limit": f"""WITH {TX_CTES}, n AS (SELECT count(*) AS n FROM tx_std WHERE is_valid)
        SELECT tx_std.*, CAST(NULL AS BIGINT) AS load_1, n AS load_2, n AS load_3 FROM tx_std, n WHERE is_valid""",
    "stream_zscore_history": _ZSCORES,
    "stream_zscore_after_history": f"""SELECT z.* FROM ({_ZSCORES}) z
        JOIN (SELECT 'E' || CAST(event_id AS VARCHAR) AS transaction_id FROM ({SLICED}) WHERE s > 2) USING (transaction_id)""",
    "stream_moving_average_5_by_state": TABLE_ORACLES["moving_average_5"],
    "stream_late_rows_kept": _LATE,
    "stream_gate": f"""SELECT transaction_id, NOT bad_amount AND NOT no_customer AS accepted,
        concat_ws(',', CASE WHEN bad_amount THEN 'between_amount' END, CASE WHEN bad_id THEN 'matches_regex_transaction_id' END,
          CASE WHEN no_customer THEN 'not_null_customer_id' END) AS failed_rules FROM ({_JUDGED})""",
    "stream_gate_counters": f"""SELECT batch_id, unnest(['rows', 'accepted', 'rejected', 'failed not_null_customer_id',
          'failed between_amount', 'failed matches_regex_transaction_id', 'alert']) AS name,
        unnest([n, ok, bad, c, a, t, CAST(bad >= {REJECTION_LIMIT} AS BIGINT)]) AS value FROM ({_COUNTS})""",
    "window_features_panes": TABLE_ORACLES["window_features"],
    "window_features_day_by_minute": f"""WITH {STREAM_CTE}, rows_in AS (
        SELECT customer_id, amount, epoch_us(event_ts) // 60000000 - unnest(range(1440)) AS start FROM tx_stream),
      f AS (SELECT customer_id, start, avg(amount) AS m, stddev_samp(amount) AS d, count(*) AS n FROM rows_in GROUP BY 1, 2)
      SELECT customer_id, count(*) AS windows, CAST(sum(CASE WHEN m > 60 OR n > 6 OR d > 55 THEN 1 ELSE 0 END) AS BIGINT) AS flagged_windows,
        CAST(sum(n) AS BIGINT) AS rows_in_windows, max(n) AS most_rows, round(max(m), 6) AS highest_avg, round(max(d), 6) AS highest_stddev
      FROM f GROUP BY customer_id""",
}
