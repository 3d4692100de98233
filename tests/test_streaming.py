import json
import os
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyfold.operators import skew
from tallyfold.operators.metrics import run_metrics
from tallyfold.operators.ordered import moving_average
from tallyfold.sinks.warehouse import files
from tallyfold.streaming.features import (FeatureSettings, feature_log, feature_rows, start_appends, start_sink,
                                          start_upserts, state_settings)
from tallyfold.streaming.moving import last_rows_log, moving_average_stream, start_moving_average
from tallyfold.streaming.parse import parse_transactions, start_landing
from tallyfold.streaming.progress import ProgressLog
from tallyfold.workload import streaming as workload
from tallyfold.workload.tables import tx_stream

NO_WATERMARK = FeatureSettings(watermark=None)
START = datetime(2025, 10, 14, 10)


def message(i, customer, amount, minute):
    return {"transaction_id": f"t{i:03}", "customer_id": customer, "amount": amount,
            "timestamp": (START + timedelta(minutes=minute)).isoformat()}


def put(spark, folder, records, order=[0]):
    """One more file of messages; file times rise so that files are read in this order."""
    import glob
    import os
    order[0] += 1
    before = set(glob.glob(f"{folder}/*.parquet"))
    values = [(r if isinstance(r, bytes) else json.dumps(r).encode() if r is not None else None,) for r in records]
    spark.createDataFrame(values, "value binary").coalesce(1).write.mode("append").parquet(str(folder))
    for new in set(glob.glob(f"{folder}/*.parquet")) - before:
        os.utime(new, (1_700_000_000 + order[0], 1_700_000_000 + order[0]))


def stream(spark, folder, per_batch=1):
    return spark.readStream.schema("value binary").option("maxFilesPerTrigger", per_batch).parquet(str(folder))


def table(spark, folder):
    return parse_transactions(spark.read.schema("value binary").parquet(str(folder)))[0]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_parse(spark):
    messages = [b"{bad", b"", None, b"[]", b"{}", b'{"transaction_id": 7, "customer_id": "c", "amount": "x"}',
                b'{"transaction_id": "t", "amount": 1, "timestamp": "2025-10-14T10:00:00Z", "more": 1}']
    good, bad = parse_transactions(spark.createDataFrame([(m,) for m in messages], "value binary"))
    assert rows(good) == [("7", "c", None, None), ("t", None, 1.0, datetime(2025, 10, 14, 10))]
    assert bad.count() == 5


def test_upserts_over_restarts_equal_the_batch_result(spark, tmp_path):
    src, out, chk = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "chk")
    put(spark, src, [message(1, "a", 10.0, 0), message(2, "a", 20.0, 1), b"{bad"])
    put(spark, src, [message(3, "b", 5.0, 2)])
    features = feature_rows(parse_transactions(stream(spark, src))[0], NO_WATERMARK)
    log = feature_log(out, features.schema)
    start_upserts(features, log, chk, every=None).awaitTermination()
    put(spark, src, [message(4, "a", 90.0, 3), message(5, "b", 1.0, -30)])
    start_upserts(features, log, chk, every=None).awaitTermination()
    want = feature_rows(table(spark, src), NO_WATERMARK)
    assert rows(log.current(spark)) == rows(want)
    assert log.history(spark).count() > want.count()


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 3), min_size=6, max_size=6))
def test_any_split_into_files_gives_the_same_windows(spark, tmp_path_factory, split):
    src, base = tmp_path_factory.mktemp("src"), tmp_path_factory.mktemp("run")
    data = [message(i, "ab"[i % 2], float(i), i * 3) for i in range(6)]
    for part in sorted(set(split)):
        put(spark, src, [m for m, s in zip(data, split) if s == part])
    features = feature_rows(parse_transactions(stream(spark, src))[0], NO_WATERMARK)
    log = feature_log(str(base / "out"), features.schema)
    with state_settings(spark, partitions=2):
        start_upserts(features, log, str(base / "chk"), every=None).awaitTermination()
    assert rows(log.current(spark)) == rows(feature_rows(table(spark, src), NO_WATERMARK))


def test_watermark_drops_late_rows_and_closes_windows(spark, tmp_path):
    src = tmp_path / "src"
    put(spark, src, [message(1, "a", 10.0, 0)])
    put(spark, src, [message(2, "a", 10.0, 60)])
    put(spark, src, [message(5, "a", 10.0, 61)])  # lateness is judged by the watermark of the batch before
    put(spark, src, [message(3, "a", 99.0, 0)])
    put(spark, src, [message(4, "a", 10.0, 120)])
    closed = feature_rows(parse_transactions(stream(spark, src))[0])
    start_appends(closed, str(tmp_path / "out"), str(tmp_path / "chk"), every=None).awaitTermination()
    got = spark.read.schema(closed.schema).parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r.window_start.hour, r.window_start.minute, r.rolling_avg_amount) for r in got] == [
        (9, 55, 10.0), (10, 0, 10.0), (10, 55, 10.0), (11, 0, 10.0)]


def test_append_without_watermark_is_refused(spark, tmp_path):
    src = tmp_path / "src"
    put(spark, src, [message(1, "a", 10.0, 0)])
    with pytest.raises(Exception, match="watermark"):
        start_appends(feature_rows(parse_transactions(stream(spark, src))[0], NO_WATERMARK), str(tmp_path / "o"), str(tmp_path / "c"))


def test_moving_average_over_batches_and_restart(spark, tmp_path):
    src, out, chk = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "chk")
    put(spark, src, [message(2, "a", 4.0, 2), message(1, "a", 2.0, 1), message(3, "b", 7.0, 1)])
    put(spark, src, [message(i, "a", float(i), i) for i in range(5, 10)] + [message(4, "a", None, 4)])
    average = moving_average_stream(parse_transactions(stream(spark, src))[0])
    with state_settings(spark, partitions=2):
        start_appends(average, out, chk, every=None).awaitTermination()
    put(spark, src, [message(20, "a", 50.0, 20), message(21, "b", 9.0, 20), message(22, None, 1.0, 20)])
    start_appends(average, out, chk, every=None).awaitTermination()
    want = moving_average(table(spark, src))
    assert rows(spark.read.schema(average.schema).parquet(out)) == rows(want.select(average.columns))


@pytest.mark.parametrize("min_rows", [2, 1000])
def test_moving_average_by_batch(spark, tmp_path, monkeypatch, min_rows):
    monkeypatch.setattr(skew, "MIN_ROWS", min_rows)
    src, out, chk = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "chk")
    put(spark, src, [message(2, "a", 4.0, 2), message(1, "a", 2.0, 1), message(3, "b", 7.0, 1)])
    put(spark, src, [message(i, "a", float(i), i) for i in range(5, 12)] + [message(4, "a", None, 4)])
    stream_rows = parse_transactions(stream(spark, src))[0]
    log = last_rows_log(str(tmp_path / "last"), stream_rows)
    start_moving_average(stream_rows, out, log, chk, every=None).awaitTermination()
    put(spark, src, [message(20, "a", 50.0, 20), message(21, "b", 9.0, 20), message(22, None, 1.0, 20)])
    put(spark, src, [message(23, "b", 3.0, 21), message(24, None, 3.0, 21)])
    start_moving_average(stream_rows, out, log, chk, every=None).awaitTermination()
    want = moving_average(table(spark, src))
    got = spark.read.parquet(out).drop("epoch", "batch_id")
    assert rows(got.select(want.columns)) == rows(want)
    last = {r.customer_id: [v.amount for v in r._last] for r in log.current(spark).collect()}
    assert last == {"a": [9.0, 10.0, 11.0, 50.0], "b": [7.0, 9.0, 3.0], None: [1.0, 3.0]}


def test_a_late_row_counts_when_it_arrives(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    put(spark, src, [message(1, "a", 1.0, 10), message(2, "a", 3.0, 11)])
    put(spark, src, [message(3, "a", 8.0, 0)])
    put(spark, src, [message(4, "a", 4.0, 12)])
    stream_rows = parse_transactions(stream(spark, src))[0]
    log = last_rows_log(str(tmp_path / "last"), stream_rows)
    start_moving_average(stream_rows, out, log, str(tmp_path / "chk"), 3, every=None).awaitTermination()
    got = {r.transaction_id: r.moving_avg_amount for r in spark.read.parquet(out).collect()}
    assert got == {"t001": 1.0, "t002": 2.0, "t003": 4.0, "t004": 5.0}


def test_state_on_disk(spark, tmp_path):
    src = tmp_path / "src"
    put(spark, src, [message(i, "a", float(i), i) for i in range(4)])
    features = feature_rows(parse_transactions(stream(spark, src))[0], NO_WATERMARK)
    log = feature_log(str(tmp_path / "out"), features.schema)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with state_settings(spark, partitions=2, on_disk=True):
        start_upserts(features, log, str(tmp_path / "chk"), every=None).awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert rows(log.current(spark)) == rows(feature_rows(table(spark, src), NO_WATERMARK))


def test_landing_keeps_both_halves(spark, tmp_path):
    src, good, bad = tmp_path / "src", str(tmp_path / "good"), str(tmp_path / "bad")
    put(spark, src, [message(1, "a", 1.0, 0), b"{bad"])
    put(spark, src, [message(2, "a", 1.0, 0)])
    start_landing(stream(spark, src), good, bad, str(tmp_path / "chk"), every=None).awaitTermination()
    assert spark.read.parquet(good).count() == 2
    assert [r.value for r in spark.read.parquet(bad).collect()] == ["{bad"]


def test_sink_and_progress(spark, tmp_path):
    src = tmp_path / "src"
    put(spark, src, [message(1, "a", 1.0, 0), message(2, "b", 1.0, 0)])
    put(spark, src, [message(3, "a", 1.0, 0)])
    log = ProgressLog(spark, str(tmp_path / "log"), "p").start()
    log.wait(start_sink(parse_transactions(stream(spark, src))[0], "t", files(str(tmp_path)), str(tmp_path / "chk"), every=None))
    log.stop()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    progress = run_metrics(log.table()).orderBy("batch_id").collect()
    assert [r.records for r in progress][:2] == [2, 1]
    assert all(r.latency_seconds > 0 for r in progress[:2])


def test_progress_keeps_more_triggers_than_spark(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "log"), "p", group=40)

    class Event:
        exception, runId = None, "r"

        def __init__(self, number):
            self.progress = type("P", (), {"timestamp": "2025-10-14T10:00:00.000Z", "durationMs": {"triggerExecution": 5},
                                           "batchId": number, "numInputRows": 2})
    for number in range(130):
        log.onQueryProgress(Event(number))
    log.onQueryTerminated(Event(0))
    assert log.table().count() == 130 and len({r.batch_id for r in log.table().collect()}) == 130


def test_a_new_checkpoint_adds_to_what_is_there(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    for run, records in enumerate([[message(1, "a", 1.0, 0), b"{bad"], [message(2, "a", 1.0, 0)]]):
        put(spark, tmp_path / f"src{run}", records)
        for _ in range(2):  # nothing new the second time
            start_landing(stream(spark, tmp_path / f"src{run}"), good, bad, str(tmp_path / f"chk{run}"), every=None).awaitTermination()
    assert sorted(r.transaction_id for r in spark.read.parquet(good).collect()) == ["t001", "t002"]
    assert spark.read.parquet(bad).count() == 1


def test_a_replayed_batch_replaces_its_own_folder_only(spark, tmp_path):
    log = feature_log(str(tmp_path), spark.createDataFrame([], "window_start int, window_end int, customer_id int, v int").schema)
    batch = lambda v: spark.createDataFrame([(1, 2, 3, v)], log.schema)
    for epoch, number, value in [(7, 0, 1), (7, 1, 2), (9, 0, 3), (9, 0, 4)]:
        log.write(batch(value), number, epoch)
    assert sorted(r.v for r in log.history(spark).collect()) == [1, 2, 4]
    assert [r.v for r in log.current(spark).collect()] == [4]
    assert [r.v for r in log.current(spark, before=(9, 0)).collect()] == [2]


def test_a_log_reads_no_more_files_as_it_grows_older(spark, tmp_path):
    log = replace(feature_log(str(tmp_path), spark.createDataFrame([], "window_start int, window_end int, customer_id int, v int").schema),
                  snapshot_every=3)
    seen = []
    for number in range(14):
        log.write(spark.createDataFrame([(1, 2, number % 4, number)], log.schema).coalesce(1), number, 5)
        seen.append(len(log.current(spark).inputFiles()))
    assert max(seen[6:]) <= max(seen[:6]) <= 8
    assert sorted(r.v for r in log.current(spark).collect()) == [10, 11, 12, 13]


def test_moving_average_goes_on_with_a_new_checkpoint(spark, tmp_path):
    out, log = str(tmp_path / "out"), None
    for run, records in enumerate([[message(1, "a", 2.0, 0), message(2, "a", 4.0, 1)], [message(3, "a", 6.0, 2)]]):
        put(spark, tmp_path / f"src{run}", records)
        stream_rows = parse_transactions(stream(spark, tmp_path / f"src{run}"))[0]
        log = last_rows_log(str(tmp_path / "last"), stream_rows)
        start_moving_average(stream_rows, out, log, str(tmp_path / f"chk{run}"), every=None).awaitTermination()
    assert sorted(r.moving_avg_amount for r in spark.read.parquet(out).collect()) == [2.0, 3.0, 4.0]


def test_nan_and_ties_count_alike_in_all_forms(spark, tmp_path):
    src = tmp_path / "src"
    put(spark, src, [b'{"transaction_id": "t1", "customer_id": "a", "amount": NaN, "timestamp": "2025-10-14T10:00:00"}',
                     message(2, "a", 4.0, 1), message(2, "a", 2.0, 1), message(2, "a", None, 1)])
    stream_rows = parse_transactions(stream(spark, src))[0]
    start_appends(moving_average_stream(stream_rows), str(tmp_path / "one"), str(tmp_path / "c1"), every=None).awaitTermination()
    start_moving_average(stream_rows, str(tmp_path / "two"), last_rows_log(str(tmp_path / "last"), stream_rows),
                         str(tmp_path / "c2"), every=None).awaitTermination()
    want = sorted(str(r.moving_avg_amount) for r in moving_average(table(spark, src)).collect())
    assert want == ["2.0", "3.0", "None", "None"]
    for out in ("one", "two"):
        assert sorted(str(r.moving_avg_amount) for r in spark.read.parquet(str(tmp_path / out)).collect()) == want


def test_messages_are_parsed_once(spark):
    messages = spark.createDataFrame([(b"{}",)], "value binary")
    for half in parse_transactions(messages):
        assert half._jdf.queryExecution().optimizedPlan().toString().lower().count("from_json") == 1


def test_interval_trigger_and_stop(spark, tmp_path):
    src = tmp_path / "src"
    put(spark, src, [message(1, "a", 1.0, 0)])
    query = start_sink(parse_transactions(stream(spark, src))[0], "t", files(str(tmp_path)), str(tmp_path / "chk"), every="1 second")
    query.processAllAvailable()
    query.stop()
    assert not query.isActive and spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_rows_of_a_customer_are_sorted_by_time_alone_where_it_decides(monkeypatch):
    import pandas as pd

    from tallyfold.streaming import moving

    order = ["timestamp", "transaction_id", "amount"]
    times = pd.to_datetime([3, 1, 2, 0], unit="s")
    apart = pd.DataFrame({"transaction_id": list("abcd"), "amount": [1.0, None, 3.0, 4.0], "timestamp": times})
    tied = apart.assign(timestamp=[times[0], times[1], times[0], pd.NaT], transaction_id=["b", "x", None, "y"])
    want = tied.sort_values(order, kind="stable", na_position="first")
    assert list(want.index) == [3, 1, 2, 0]
    pd.testing.assert_frame_equal(moving._sorted(tied, order), want)
    monkeypatch.setattr(pd.DataFrame, "sort_values", None)
    assert list(moving._sorted(apart, order).index) == [3, 1, 2, 0]


def test_a_large_backlog_is_read_by_more_tasks_and_keeps_its_state_on_disk(spark, tmp_path, monkeypatch):
    """Files grow with the events, a trigger still reads one slice, and the windows are those of the table."""
    events = spark.range(25_000).select(
        F.col("id").alias("event_id"), F.expr("timestamp_seconds(1704067200 + id * 31 + id % 7)").alias("ts"), (F.col("id") % 50).alias("user_id"),
        F.lit("view").alias("event_type"), (F.col("id") % 97 + 0.25).alias("value"), F.lit("{}").alias("props"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(workload, "FILE_ROWS", 2000)
    monkeypatch.setattr(workload, "STATE_ROWS", 1500)
    made = []
    monkeypatch.setattr(workload, "run_dir", lambda spark, purpose: made.append(str(tmp_path / f"{len(made)}-{purpose}")) or made[-1])
    conf = spark.conf.getAll
    got = workload.upserted_in_two_runs(spark, str(tmp_path)).collect()
    assert spark.conf.getAll == conf
    feed, *_, second = [path for path in made if path.endswith(("feed", "checkpoint"))]
    assert len([name for name in os.listdir(feed) if name.endswith(".parquet")]) == 5 * 3
    with open(f"{second}/offsets/0") as offsets:
        started_with = offsets.read()
    assert "RocksDBStateStoreProvider" in started_with and '"spark.sql.shuffle.partitions":"17"' in started_with
    rows = feature_rows(tx_stream(spark, str(tmp_path)).withColumnRenamed("event_ts", "timestamp"))
    want = workload.rounded(workload.without_zone(rows, "window_start", "window_end"), "rolling_avg_amount", "stddev_amount").collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) > 10_000


@pytest.mark.parametrize("rows, files", [([], 2), ([10, 0, 10, 10, 10], 2), ([10**6] * 4, 2), ([10**6] * 5, 10), ([10**6] * 4 + [4500], 4)])
def test_no_file_of_a_slice_is_empty(rows, files):
    assert workload.files_of(rows) == files
