from datetime import datetime as at, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyfold.functions.alerts import BATCH_LIMITS, STREAM_LIMITS, AnomalyLimits, anomaly_flag
from tallyfold.operators.features import flag_anomalies, window_features


def tx(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, customer_id string, amount double, timestamp timestamp_ntz")


def test_each_row_is_in_two_windows(spark):
    rows = [("tx001", "1", 150.0, at(2025, 10, 14, 10)), ("tx002", "2", 50.0, at(2025, 10, 14, 10, 0, 10))]
    got = flag_anomalies(window_features(tx(spark, rows)), STREAM_LIMITS).collect()
    assert {(r.window_start, r.window_end, r.customer_id) for r in got} == {
        (at(2025, 10, 14, *start), at(2025, 10, 14, *end), c)
        for start, end in (((9, 55), (10, 5)), ((10, 0), (10, 10))) for c in "12"}
    assert {(r.transaction_count, r.stddev_amount, r.anomaly_flag) for r in got} == {(1, None, 0)}


def test_nulls(spark):
    rows = [("a", "1", None, at(2025, 1, 1)), ("b", "1", 4.0, at(2025, 1, 1)), ("c", "1", 9.0, None), ("d", None, 2.0, at(2025, 1, 1))]
    got = {r.customer_id: r for r in window_features(tx(spark, rows), "1 hour", "1 hour").collect()}
    assert (got["1"].transaction_count, got["1"].rolling_avg_amount, got["1"].stddev_amount) == (2, 4.0, None)
    assert got[None].transaction_count == 1


def test_sample_deviation(spark):
    rows = [(str(i), "1", v, at(2025, 1, 1)) for i, v in enumerate((2.0, 4.0))]
    assert window_features(tx(spark, rows), "1 hour", "1 hour").first().stddev_amount == pytest.approx(2 ** 0.5)


@pytest.mark.parametrize("avg, count, sd, batch, stream", [
    (10000.0, 50, 5000.0, 0, 0), (10000.01, 1, None, 1, 1), (None, 51, None, 1, 1), (1.0, 1, 5000.5, 1, 0),
    (None, 1, None, 0, 0), (float("nan"), 1, None, 1, 1)])
def test_limits(spark, avg, count, sd, batch, stream):
    df = spark.createDataFrame([(avg, count, sd)], "rolling_avg_amount double, transaction_count long, stddev_amount double")
    row = df.select(anomaly_flag(BATCH_LIMITS).alias("b"), anomaly_flag(STREAM_LIMITS).alias("s"),
                    anomaly_flag(AnomalyLimits(None, None, None)).alias("n")).first()
    assert (row.b, row.s, row.n) == (batch, stream, 0)


def test_amounts_combine_before_the_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("unused", F.lit(1))
    plan = window_features(df, event_time="ts", amount="value", key="user_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange") < plan.index("partial_avg") < plan.index("Expand")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    assert "PushedFilters: [IsNotNull(ts)]" in plan


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-50, 50)), st.integers(0, 3600)),
                min_size=1, max_size=25))
def test_windows_against_brute_force(spark, data):
    start = at(2025, 1, 1)
    rows = [(str(i), c, None if v is None else float(v), start + timedelta(seconds=s)) for i, (c, v, s) in enumerate(data)]
    want = {}
    for _, c, v, ts in rows:
        for back in (0, 5):
            first = start + timedelta(minutes=(ts - start).seconds // 300 * 5 - back)
            want.setdefault((first, first + timedelta(minutes=10), c), []).append(v)
    got = {(r.window_start, r.window_end, r.customer_id): (r.transaction_count, r.rolling_avg_amount)
           for r in window_features(tx(spark, rows)).collect()}
    assert got.keys() == want.keys()
    for key, amounts in want.items():
        known = [v for v in amounts if v is not None]
        assert got[key] == (len(amounts), pytest.approx(sum(known) / len(known)) if known else None)
