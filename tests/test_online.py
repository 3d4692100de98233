"""State per customer, late rows, rules inside a stream."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyfold.operators.ordered import moving_average
from tallyfold.quality.rules import Rule
from tallyfold.streaming.features import FeatureSettings, start_appends, state_settings
from tallyfold.streaming.gate import rejection_alerts, start_gate
from tallyfold.streaming.late import start_late_split
from tallyfold.streaming.progress import ProgressLog
from tallyfold.streaming.stateful import history_moments, moving_average_state, zscore_stream

START = datetime(2025, 1, 1)
SCHEMA = "transaction_id string, customer_id string, amount double, timestamp timestamp"


def feed(spark, folder, *batches):
    """Each list of rows becomes a file, and a trigger reads one."""
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def tx(number, customer, amount, minute):
    return (f"t{number}", customer, amount, None if minute is None else START + timedelta(minutes=minute))


def run(rows, out, checkpoint):
    with state_settings(rows.sparkSession, partitions=2, on_disk=True):
        start_appends(rows, out, checkpoint, every=None).awaitTermination()
    return {r.transaction_id: r for r in rows.sparkSession.read.schema(rows.schema).parquet(out).collect()}


def test_zscore_against_all_rows_before(spark, tmp_path):
    amounts = [1.0, 2.0, None, 3.0, float("nan"), 100.0, 4.0, 4.0]
    rows = [tx(i, "a", v, i) for i, v in enumerate(amounts)] + [tx(20 + i, None, 5.0, i) for i in range(3)]
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    # Within a file the order does not matter, across files and a restart the state goes on.
    scored = zscore_stream(feed(spark, source, rows[:4][::-1]))
    run(scored, out, checkpoint)
    got = run(zscore_stream(feed(spark, source, rows[4:])), out, checkpoint)
    assert len(got) == len(rows)
    seen = []
    for i, value in enumerate(amounts):
        mean = sum(seen) / len(seen) if seen else None
        spread = math.sqrt(sum((v - mean) ** 2 for v in seen) / (len(seen) - 1)) if len(seen) > 1 else None
        r = got[f"t{i}"]
        assert r.baseline_avg == (None if mean is None else pytest.approx(mean)) and r.baseline_stddev == (None if spread is None else pytest.approx(spread))
        if value is not None and not math.isnan(value):
            seen.append(value)
            assert r.z_flag == int(bool(spread) and abs(value - mean) > 2.5 * spread)
    assert got["t5"].z_flag == 1 and got["t21"].baseline_avg == 5.0 and got["t22"].z_score is None


def test_state_begins_with_a_table(spark, tmp_path):
    history = spark.createDataFrame([tx(i, "a", float(v), i) for i, v in enumerate((1, 3, 5))] + [tx(9, "gone", None, 1)], SCHEMA)
    source = feed(spark, str(tmp_path / "in"), [tx(10, "a", 7.0, 10), tx(11, "new", 1.0, 10), tx(12, "gone", 2.0, 11)])
    got = run(zscore_stream(source, initial=history_moments(history)), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert (got["t10"].baseline_avg, got["t10"].baseline_stddev) == (3.0, 2.0) and got["t10"].z_score == 2.0
    assert got["t11"].baseline_avg is None and got["t12"].baseline_avg is None
    last = history.where("amount is not null").groupBy("customer_id").agg(F.sort_array(F.collect_list("amount")).alias("amounts"))
    source = feed(spark, str(tmp_path / "in2"), [tx(10, "a", 7.0, 10), tx(11, "new", 1.0, 10)])
    got = run(moving_average_state(source, 3, initial=last), str(tmp_path / "out2"), str(tmp_path / "ck2"))
    assert got["t10"].moving_avg_amount == 5.0 and got["t11"].moving_avg_amount == 1.0


@pytest.mark.parametrize("rows", [1, 2, 5])
def test_moving_average_equals_the_table_form(spark, tmp_path, rows):
    data = [tx(i, f"c{i * i % 3}", None if i % 7 == 3 else float(i * 37 % 11), i) for i in range(40)]
    got = run(moving_average_state(feed(spark, str(tmp_path / "in"), data[:15], data[15:30], data[30:]), rows),
              str(tmp_path / "out"), str(tmp_path / "ck"))
    want = moving_average(spark.createDataFrame(data, SCHEMA), rows).collect()
    assert {k: r.moving_avg_amount for k, r in got.items()} == {r.transaction_id: pytest.approx(r.moving_avg_amount) if r.moving_avg_amount is not None
                                                                else None for r in want}


def test_late_rows_go_to_their_own_table(spark, tmp_path):
    names = [str(tmp_path / n) for n in ("accepted", "late", "log", "ck")]
    settings = FeatureSettings("10 minutes", "5 minutes", watermark="1 minute")
    source = str(tmp_path / "in")

    def start(*batches):
        start_late_split(feed(spark, source, *batches), *names, settings, every=None).awaitTermination()

    # After minute 30 the watermark stands at 29: windows that end by then are closed.
    start([tx(1, "a", 1.0, 0), tx(2, "a", 1.0, 30)], [tx(3, "a", 1.0, 12), tx(4, "a", 1.0, 16), tx(5, "a", 1.0, 22), tx(6, "a", 1.0, None)])
    # A restart goes on with the watermark; an empty batch of old rows does not move it back.
    start([tx(7, "a", 1.0, 3)], [tx(8, "a", 1.0, 26)])
    accepted = {r.transaction_id: r.closed_windows for r in spark.read.parquet(names[0]).collect()}
    late = {r.transaction_id: (r.closed_windows, r.reason) for r in spark.read.parquet(names[1]).collect()}
    assert accepted == {"t1": 0, "t2": 0, "t5": 1, "t8": 0}
    assert late == {"t3": (2, "late"), "t4": (2, "late"), "t6": (0, "no event time"), "t7": (2, "late")}


def test_gate_counts_what_passes(spark, tmp_path):
    rules = [Rule("between", "amount", low=0, high=10), Rule("not_null", "customer_id", severity="warning"), Rule("column_exists", "channel", severity="warning")]
    log = ProgressLog(spark, str(tmp_path / "log"), "p", seconds=0.0, counters=str(tmp_path / "counters")).start()
    rows = feed(spark, str(tmp_path / "in"), [tx(1, "a", 5.0, 1), tx(2, None, 50.0, 1)], [tx(3, None, 1.0, 2), tx(4, "a", None, 2)])
    try:
        log.wait(start_gate(rows, rules, str(tmp_path / "out"), str(tmp_path / "ck"), every=None))
    finally:
        log.stop()
    got = {r.transaction_id: (str(r.accepted), sorted(r.failed_rules)) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    no_channel = "column_exists_channel"
    assert got == {"t1": ("true", [no_channel]), "t2": ("false", ["between_amount", no_channel, "not_null_customer_id"]),
                   "t3": ("true", [no_channel, "not_null_customer_id"]), "t4": ("true", [no_channel])}
    counters = {(r.batch_id, r.name): r.value for r in log.counters().collect()}
    assert [counters[b, n] for b in (0, 1) for n in ("rows", "accepted", "rejected", "failed between_amount", "failed not_null_customer_id")] == [
        2, 1, 1, 1, 1, 2, 2, 0, 0, 1]
    alerts = {r.batch_id: (r.errors, r.alert) for r in rejection_alerts(log.counters(), limit=1).collect()}
    assert alerts == {0: (1, True), 1: (0, False)}
    with pytest.raises(ValueError):
        start_gate(rows, [Rule("unique", "transaction_id")], str(tmp_path / "o"), str(tmp_path / "c"), every=None)
