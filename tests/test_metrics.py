from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyfold.functions.alerts import error_alert, latency_alert
from tallyfold.operators.metrics import error_counts, freshness, metric_rows, run_metrics
from tallyfold.schemas import BATCH_METRIC


def test_latency_and_throughput(spark):
    t = [datetime(2025, 1, 1, 0, 0, 0), datetime(2025, 1, 1, 0, 0, 1, 500600)]
    rows = [("p", 1, t[0], t[1], 10, "ok"), ("p", 2, t[0], t[0], 10, "ok"), ("p", 3, t[0], None, 10, "ok")]
    got = {r.batch_id: (r.latency_seconds, r.records_per_second, r.latency_alert)
           for r in run_metrics(spark.createDataFrame(rows, BATCH_METRIC)).collect()}
    assert got == {1: (1.501, 6.66, True), 2: (0.0, 0.0, False), 3: (None, 0.0, False)}


@pytest.mark.parametrize("latency, limit, want", [(0.8, 0.8, False), (0.81, 0.8, True), (0.0, -1.0, False), (None, 0.1, False)])
def test_latency_alert(spark, latency, limit, want):
    assert spark.createDataFrame([(latency,)], "l double").select(latency_alert(F.col("l"), limit)).first()[0] is want


@pytest.mark.parametrize("errors, want", [(4, False), (5, True), (None, False)])
def test_error_alert(spark, errors, want):
    assert spark.createDataFrame([(errors,)], "e long").select(error_alert(F.col("e"))).first()[0] is want


def test_error_counts(spark):
    df = spark.createDataFrame([("a", "error")] * 5 + [("a", "ok"), ("b", "ok")], "pipeline string, status string")
    assert sorted(map(tuple, error_counts(df).collect())) == [("a", 5, True), ("b", 0, False)]


def test_metric_rows(spark):
    assert sorted(map(tuple, metric_rows(spark.sql("select 1 a, 2.5D b")).collect())) == [("a", 1.0), ("b", 2.5)]


def test_freshness(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 1),), (None,)], "t timestamp_ntz")
    got = freshness({"x": (df, "t"), "none": (df.where("t is null"), "t")}, datetime(2025, 1, 1, 0, 1))
    assert {r.source: r.lag_seconds for r in got.collect()} == {"x": 60, "none": None}
