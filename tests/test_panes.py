"""Windows by panes against windows by repeated rows."""

import re
from datetime import datetime, timedelta, timezone

import pytest

from tallyfold.operators import panes
from tallyfold.operators.features import window_features
from tallyfold.operators.panes import each_window, micros, pane_window_features, pane_window_runs

START = datetime(1969, 12, 31, 20, 0, tzinfo=timezone.utc)


def rows(spark):
    at = lambda minutes: START + timedelta(minutes=minutes, microseconds=int(minutes * 7919) % 1_000_000)
    found = [(f"c{i % 3}", at((i * i * 37) % 2000), None if i % 11 == 0 else 1e6 + (i * 7) % 13 / 10) for i in range(300)]
    found += [(None, at(5), 1.0), (None, at(6), 3.0), ("c0", None, 5.0), ("far", at(600_000), 2.0), ("nan", at(1), float("nan")),
              ("nan", at(200), 1.0), ("nan", at(2000), 4.0), ("nan", at(2001), 6.0), ("null", at(1), None)]
    return spark.createDataFrame(found, "customer_id string, timestamp timestamp, amount double")


def comparable(df):
    out = {}
    for r in df.collect():
        key = (r.window_start, r.window_end, r.customer_id)
        assert key not in out
        text = [None if v is None else "nan" if v != v else round(v, 6) for v in (r.rolling_avg_amount, r.stddev_amount)]
        out[key] = (*text, r.transaction_count)
    return out


@pytest.mark.parametrize("window, slide", [("10 minutes", "5 minutes"), ("1 hour", "1 hour"), ("3 hours", "1 minute"), ("50 minutes", "20 minutes"),
                                           ("1 day", "7 hours")])
def test_same_rows_as_the_plain_form(spark, window, slide):
    df = rows(spark)
    want, got = comparable(window_features(df, window, slide)), comparable(pane_window_features(df, window, slide))
    assert set(got) == set(want)
    for key, (mean, spread, n) in want.items():
        assert got[key][2] == n
        # The deviation of equal amounts may be a rounding error away from zero.
        for have, expected, room in ((got[key][0], mean, 1e-6), (got[key][1], spread, 1e-5)):
            assert have == expected if expected in (None, "nan") else have == pytest.approx(expected, abs=room)


def test_runs_are_maximal_inside_a_block_and_disjoint(spark):
    df = spark.createDataFrame([("a", START, 1.0), ("a", START + timedelta(hours=30), 2.0)], "customer_id string, timestamp timestamp, amount double")
    runs = pane_window_runs(df, "24 hours", "1 minute").orderBy("first_start").collect()
    assert sum((r.last_start - r.first_start) // micros("1 minute") + 1 for r in runs) == 2 * 1440
    assert all(a.last_start < b.first_start for a, b in zip(runs, runs[1:])) and len(runs) <= 6
    assert each_window(pane_window_runs(df, "24 hours", "1 minute"), micros("24 hours"), micros("1 minute")).count() == 2 * 1440


def test_rows_do_not_multiply_before_the_shuffle(spark):
    """The plan combines rows per pane before its first exchange, and nothing but panes is repeated after it."""
    plan = pane_window_features(rows(spark), "24 hours", "1 minute")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "partial_var_pop" in below and "Generate" not in below and "Expand" not in below


def test_tasks_follow_the_panes(spark, monkeypatch):
    """Adaptive execution may not merge partitions by their bytes before the panes become entries."""
    monkeypatch.setattr(panes, "TASK_PANES", 10)
    df = rows(spark)
    got = pane_window_features(df, "3 hours", "1 minute")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(customer_id#\d+, _block#\d+L, 31\), REPARTITION_BY_NUM", plan) and df.count() == 309
    assert comparable(got).keys() == comparable(window_features(df, "3 hours", "1 minute")).keys()


def test_empty_and_wrong_arguments(spark):
    assert pane_window_features(rows(spark).where("false"), "1 hour", "1 minute").collect() == []
    with pytest.raises(ValueError):
        pane_window_runs(rows(spark), "1 minute", "1 hour")
    with pytest.raises(ValueError):
        micros("1 month")
    assert micros("10 minutes") == 600_000_000 == micros("600 seconds") and micros("1 day") == 24 * micros("1 HOUR")
