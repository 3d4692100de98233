"""Streaming queries run over the given events until nothing is left to read."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators.metrics import run_metrics
from ..sinks.warehouse import files
from ..streaming.features import (FeatureSettings, feature_log, feature_rows, start_appends, start_sink,
                                  start_upserts, state_settings)
from ..streaming.moving import last_rows_log, moving_average_stream, start_moving_average
from ..streaming.parse import parse_transactions, start_landing
from ..streaming.progress import ProgressLog
from ..workspace import run_dir
from .features import _EVENTS_10_5, ORACLES as TABLE_ORACLES, flag_sql, rounded
from .tables import STREAM_CTE, table

WALL_CLOCK = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


# The events are cut by time into so many slices of so many files at least, and a trigger reads one slice.
SLICES, FILES = 5, 2
# Events of a file, and of a partition of the state; state of more than one partition's events goes to disk.
FILE_ROWS, STATE_ROWS = 100_000, 500_000


def sliced(events):
    """``_slice``: which of ``SLICES`` equal stretches of time an event lies in."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(us), F.max(us)).first()
    return events.withColumn("_slice", F.expr(
        f"cast((unix_micros(cast(ts as timestamp)) - {first}L) * {SLICES}L div ({last}L - {first}L + 1L) as int)"))


def files_of(rows):
    """Files of every slice, given their numbers of rows; no file of the smallest slice may be without rows."""
    return max(FILES, min(-(-sum(rows) // (SLICES * FILE_ROWS)), min(rows, default=0) // 1000 if len(rows) == SLICES else 0))


class Feed:
    """A folder of event files; slices are added one after the other, and read in that order."""

    def __init__(self, spark, sf_dir):
        self.spark, self.events, self.path = spark, table(spark, sf_dir, "events"), run_dir(spark, "feed")
        self.slices = sliced(self.events)
        rows = [n for _, n in self.slices.where("_slice is not null").groupBy("_slice").count().collect()]
        self.rows, self.files = sum(rows), files_of(rows)

    def add(self, *numbers):
        for number in numbers:
            (self.slices.where(F.col("_slice") == number).drop("_slice").repartition(self.files)
             .write.mode("append").parquet(self.path))
        return self

    def state(self):
        """Settings for state that grows with the events: its partitions do not grow, and it is kept on disk once it is large."""
        many = self.rows > STATE_ROWS
        return state_settings(self.spark, max(self.spark.sparkContext.defaultParallelism, -(-self.rows // STATE_ROWS)), many, many)

    def messages(self, spoil=False):
        """The events as a message stream: JSON text as bytes, every 101st one broken on request."""
        events = (self.spark.readStream.schema(self.events.schema).option("maxFilesPerTrigger", self.files)
                  .parquet(self.path))
        payload = F.to_json(F.struct(
            F.concat(F.lit("E"), F.col("event_id")).alias("transaction_id"),
            F.col("user_id").cast("string").alias("customer_id"),
            F.col("value").alias("amount"), F.date_format("ts", WALL_CLOCK).alias("timestamp")))
        if spoil:
            payload = F.when(F.col("event_id") % 101 == 0, F.concat(F.lit("{bad "), F.col("event_id"))).otherwise(payload)
        return events.select(payload.cast("binary").alias("value"))

    def transactions(self):
        return parse_transactions(self.messages())[0]


def messages(spark, sf_dir, spoil=False):
    return Feed(spark, sf_dir).add(*range(SLICES)).messages(spoil)


def transactions(spark, sf_dir):
    return parse_transactions(messages(spark, sf_dir))[0]


def without_zone(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def appended(rows, name):
    """Run an append query over what is there and read its output."""
    spark = rows.sparkSession
    out = run_dir(spark, name)
    start_appends(rows, out, run_dir(spark, name + "-checkpoint"), every=None).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def parsed(spark, sf_dir):
    rows = appended(parse_transactions(messages(spark, sf_dir, spoil=True))[0], "parsed")
    return without_zone(rows, "timestamp")


def rejects(spark, sf_dir):
    return appended(parse_transactions(messages(spark, sf_dir, spoil=True))[1], "rejected")


def upserted_features(spark, sf_dir):
    rows = feature_rows(transactions(spark, sf_dir), FeatureSettings(watermark="40 days"))
    log = feature_log(run_dir(spark, "features"), rows.schema)
    start_upserts(rows, log, run_dir(spark, "features-checkpoint"), every=None).awaitTermination()
    return rounded(without_zone(log.current(spark), "window_start", "window_end"), "rolling_avg_amount", "stddev_amount")


def final_features(spark, sf_dir):
    """Windows the watermark has closed; the newest are still open."""
    rows = appended(feature_rows(transactions(spark, sf_dir)), "final-features")
    return rounded(without_zone(rows, "window_start", "window_end"), "rolling_avg_amount", "stddev_amount")


def restarted(spark, sf_dir):
    """Closed windows of a query that stops half-way and goes on from its checkpoint."""
    feed, out, checkpoint = Feed(spark, sf_dir).add(0, 1), run_dir(spark, "restart"), run_dir(spark, "restart-checkpoint")
    rows = feature_rows(feed.transactions())
    start_appends(rows, out, checkpoint, every=None).awaitTermination()
    feed.add(*range(2, SLICES))
    start_appends(rows, out, checkpoint, every=None).awaitTermination()
    written = spark.read.schema(rows.schema).parquet(out)
    return rounded(without_zone(written, "window_start", "window_end"), "rolling_avg_amount", "stddev_amount")


def late_rows(spark, sf_dir):
    """Slice 1 arrives after slices 2 and 3: the watermark has passed its windows, so its rows are dropped."""
    rows = appended(feature_rows(Feed(spark, sf_dir).add(0, 2, 3, 1, 4).transactions()), "late-rows")
    return rounded(without_zone(rows, "window_start", "window_end"), "rolling_avg_amount", "stddev_amount")


def moving_average(spark, sf_dir):
    # A customer's rows of one micro-batch meet in one task, so the micro-batch is capped by the feed.
    rows = appended(moving_average_stream(transactions(spark, sf_dir)), "moving-average")
    return rounded(without_zone(rows, "timestamp"), "moving_avg_amount").withColumnRenamed("timestamp", "event_ts")


def moving_average_by_batch(spark, sf_dir):
    """The same for a backlog of any size, in two runs with a checkpoint each; heavy customers are cut."""
    feed, out = Feed(spark, sf_dir).add(0, 1, 2), run_dir(spark, "moving-average")
    rows = feed.transactions()
    log = replace(last_rows_log(run_dir(spark, "last-rows"), rows), snapshot_every=2)
    start_moving_average(rows, out, log, run_dir(spark, "last-rows-checkpoint"), every=None).awaitTermination()
    later = Feed(spark, sf_dir).add(3, 4).transactions()
    start_moving_average(later, out, log, run_dir(spark, "last-rows-checkpoint"), every=None).awaitTermination()
    written = spark.read.parquet(out).drop("epoch", "batch_id")
    return rounded(without_zone(written, "timestamp"), "moving_avg_amount").withColumnRenamed("timestamp", "event_ts")


def _landed(spark, accepted, rejected):
    good = spark.read.parquet(accepted).select(
        F.lit("accepted").alias("half"), "transaction_id", "customer_id", "amount",
        F.col("timestamp").cast("timestamp_ntz").alias("event_ts"), F.lit(None).cast("string").alias("value"))
    bad = spark.read.parquet(rejected).select(F.lit("rejected").alias("half"), "value")
    return good.unionByName(bad, allowMissingColumns=True)


def landed(spark, sf_dir):
    """Both halves of the messages landed from one read."""
    accepted, rejected = run_dir(spark, "accepted"), run_dir(spark, "rejected")
    start_landing(messages(spark, sf_dir, spoil=True), accepted, rejected, run_dir(spark, "landing-checkpoint"),
                  every=None).awaitTermination()
    return _landed(spark, accepted, rejected)


def landed_in_two_runs(spark, sf_dir):
    """The same folders filled by two queries, each with a checkpoint of its own and batch numbers from 0."""
    accepted, rejected = run_dir(spark, "accepted"), run_dir(spark, "rejected")
    for numbers in (range(2), range(2, SLICES)):
        start_landing(Feed(spark, sf_dir).add(*numbers).messages(spoil=True), accepted, rejected,
                      run_dir(spark, "landing-checkpoint"), every=None).awaitTermination()
    return _landed(spark, accepted, rejected)


def upserted_in_two_runs(spark, sf_dir):
    """A second query reads everything again with a new checkpoint; its windows win over the first one's partial ones."""
    feed = Feed(spark, sf_dir).add(0, 1)
    rows = feature_rows(feed.transactions(), FeatureSettings(watermark="40 days"))
    log = replace(feature_log(run_dir(spark, "features"), rows.schema), snapshot_every=2)
    with feed.state():
        start_upserts(rows, log, run_dir(spark, "features-checkpoint"), every=None).awaitTermination()
    feed.add(*range(2, SLICES))
    with feed.state():
        start_upserts(rows, log, run_dir(spark, "features-checkpoint"), every=None).awaitTermination()
    return rounded(without_zone(log.current(spark), "window_start", "window_end"), "rolling_avg_amount", "stddev_amount")


def warehouse_sink(spark, sf_dir):
    """Every micro-batch appended to a warehouse table."""
    root = run_dir(spark, "stream-warehouse")
    start_sink(transactions(spark, sf_dir), "monitoring", files(root), run_dir(spark, "sink-checkpoint"),
               every=None).awaitTermination()
    return without_zone(spark.read.parquet(f"{root}/monitoring").drop("epoch", "batch_id"), "timestamp")


def progress(spark, sf_dir):
    """What the triggers of a stream report: a row per trigger with data."""
    log = ProgressLog(spark, run_dir(spark, "progress-log"), "events").start()
    try:
        log.wait(start_sink(transactions(spark, sf_dir), "monitoring", files(run_dir(spark, "progress")),
                            run_dir(spark, "progress-checkpoint"), every=None))
    finally:
        log.stop()
    triggers = run_metrics(log.table(), latency_limit=86400.0).where("records > 0")
    return triggers.select("pipeline", "batch_id", "records", "latency_alert")


QUERIES = {
    "stream_parse": parsed,
    "stream_rejects": rejects,
    "stream_features": upserted_features,
    "stream_features_final": final_features,
    "stream_moving_average_5": moving_average,
    "stream_moving_average_5_by_batch": moving_average_by_batch,
    "stream_landing": landed,
    "stream_landing_two_runs": landed_in_two_runs,
    "stream_features_two_runs": upserted_in_two_runs,
    "stream_restart": restarted,
    "stream_late_rows": late_rows,
    "stream_sink": warehouse_sink,
    "stream_progress": progress,
}

_FLAGGED = flag_sql(_EVENTS_10_5, "rolling_avg_amount > 10000 OR transaction_count > 50")

_CLOSED = f"""SELECT * FROM ({_FLAGGED}) WHERE window_end <= (SELECT max(ts) - INTERVAL '1 minute' FROM events)"""
_LANDED = f"""WITH {STREAM_CTE} SELECT CASE WHEN bad THEN 'rejected' ELSE 'accepted' END AS half,
    CASE WHEN NOT bad THEN transaction_id END AS transaction_id, CASE WHEN NOT bad THEN customer_id END AS customer_id,
    CASE WHEN NOT bad THEN amount END AS amount, CASE WHEN NOT bad THEN event_ts END AS event_ts,
    CASE WHEN bad THEN '{{bad ' || substr(transaction_id, 2) END AS value
    FROM (SELECT *, CAST(substr(transaction_id, 2) AS BIGINT) % 101 = 0 AS bad FROM tx_stream)"""
SLICED = f"""SELECT *, CAST((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM main.events)) * {SLICES}
    // ((SELECT max(epoch_us(ts)) - min(epoch_us(ts)) FROM main.events) + 1) AS BIGINT) AS s FROM main.events"""

ORACLES = {
    "stream_parse": f"""WITH {STREAM_CTE} SELECT transaction_id, customer_id, amount, event_ts AS "timestamp"
        FROM tx_stream WHERE CAST(substr(transaction_id, 2) AS BIGINT) % 101 <> 0""",
    "stream_rejects": "SELECT '{bad ' || CAST(event_id AS VARCHAR) AS value FROM events WHERE event_id % 101 = 0",
    "stream_landing": _LANDED,
    "stream_landing_two_runs": _LANDED,
    "stream_features_two_runs": _FLAGGED,
    "stream_restart": _CLOSED,
    "stream_late_rows": f"""WITH events AS (SELECT * EXCLUDE (s) FROM ({SLICED}) WHERE s <> 1)
        SELECT * FROM ({_FLAGGED}) WHERE window_end <= (SELECT max(ts) - INTERVAL '1 minute' FROM events)""",
    "stream_progress": f"""SELECT 'events' AS pipeline, s AS batch_id, count(*) AS records, false AS latency_alert
        FROM ({SLICED}) GROUP BY s""",
    "stream_sink": f"""WITH {STREAM_CTE} SELECT transaction_id, customer_id, amount, event_ts AS "timestamp" FROM tx_stream""",
    "stream_features": _FLAGGED,
    "stream_features_final": _CLOSED,
    "stream_moving_average_5": TABLE_ORACLES["moving_average_5"],
    "stream_moving_average_5_by_batch": TABLE_ORACLES["moving_average_5"],
}
