import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyfold.operators import ordered, skew
from tallyfold.operators.ordered import moving_average, with_row_frame, zscore_history, zscore_previous
from tallyfold.operators.skew import HeavyKeys, heavy_keys

SCHEMA = "transaction_id string, customer_id string, amount double, timestamp timestamp_ntz"


def rows(n=400, seed=3):
    """Half of the rows belong to one customer, a tenth to none; some amounts are missing, some times tie."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        customer = rng.choices(["hot", None, f"c{rng.randrange(40)}"], [5, 1, 4])[0]
        out.append((f"t{i:04}", customer, None if rng.random() < 0.1 else round(rng.random() * 100, 2), rng.randrange(n // 2)))
    return out


def frame(spark, data):
    df = spark.createDataFrame(data, "transaction_id string, customer_id string, amount double, s int")
    return df.withColumn("timestamp", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s")


def by_brute_force(data, lo, hi):
    """Amounts in the frame of every transaction."""
    groups = {}
    for t in sorted(data, key=lambda r: (r[3], r[0])):
        groups.setdefault(t[1], []).append(t)
    return {g[i][0]: [r[2] for r in g[max(0, i + lo):max(0, i + hi + 1)] if r[2] is not None]
            for g in groups.values() for i in range(len(g))}


@pytest.mark.parametrize("min_rows", [20, 10_000])
def test_moving_average(spark, min_rows):
    data = rows()
    df = frame(spark, data)
    heavy = heavy_keys(df, "customer_id", min_rows=min_rows)
    assert bool(heavy) == (min_rows == 20)
    got = {r.transaction_id: r.moving_avg_amount for r in moving_average(df, heavy=heavy, runs=7).collect()}
    want = by_brute_force(data, -4, 0)
    assert got.keys() == want.keys()
    for t, amounts in want.items():
        assert got[t] == (pytest.approx(sum(amounts) / len(amounts)) if amounts else None)


def test_heavy_and_plain_scores_agree(spark):
    df = frame(spark, rows(seed=9))
    plain = HeavyKeys("customer_id", df.schema["customer_id"].dataType, ())
    cut = heavy_keys(df, "customer_id", min_rows=20)
    for score in (lambda h: zscore_previous(df, heavy=h, runs=9), ):
        want = {r.transaction_id: r for r in score(plain).collect()}
        for r in score(cut).collect():
            w = want.pop(r.transaction_id)
            assert r.z_flag == w.z_flag
            assert (r.z_score is None) == (w.z_score is None)
            assert r.z_score is None or r.z_score == pytest.approx(w.z_score)
        assert not want


def test_many_small_heavy_keys_share_runs(spark, monkeypatch):
    """Runs follow the rows, not the number of heavy customers: 300 pieces of 12 rows are not 300 tasks."""
    data = [(f"t{i:04}", f"c{i % 100}", float(i % 7), i // 3) for i in range(3600)]
    df = frame(spark, data)
    heavy = heavy_keys(df, "customer_id", min_rows=12)
    assert heavy.pieces == 300 and heavy.tasks == 1
    cut, numbers = ordered._cut_into_runs, []
    monkeypatch.setattr(ordered, "_cut_into_runs", lambda *a: numbers.append(a[-1]) or cut(*a))
    got = {r.transaction_id: r.moving_avg_amount for r in moving_average(df, heavy=heavy).collect()}
    assert numbers == [8]
    assert got == {k: pytest.approx(sum(v) / len(v)) for k, v in by_brute_force(data, -4, 0).items()}
    # Where a piece is as large as a task may be, every piece stays a run of its own.
    monkeypatch.setattr(skew, "MIN_ROWS", 12)
    assert heavy_keys(df, "customer_id").tasks == 300


def test_more_runs_than_rows(spark):
    data = [(f"t{i}", "hot", float(i), i) for i in range(12)]
    df = frame(spark, data)
    heavy = heavy_keys(df, "customer_id", min_rows=3)
    got = {r.transaction_id: r.moving_avg_amount for r in moving_average(df, heavy=heavy, runs=50).collect()}
    assert got == {k: pytest.approx(sum(v) / len(v)) for k, v in by_brute_force(data, -4, 0).items()}


def test_exact_copies_are_cut_too(spark):
    copies = frame(spark, [("t", "hot", 2.0, 5)] * 300)
    heavy = heavy_keys(copies, "customer_id", min_rows=10)
    got = moving_average(copies, heavy=heavy, runs=6)
    assert [r.moving_avg_amount for r in got.collect()] == [2.0] * 300


def test_copies_on_both_sides_of_a_cut(spark):
    """A copy that lies in the run before precedes the copy in the run itself."""
    twice = frame(spark, [(f"t{i:02}", "hot", float(i * i), i) for i in range(30) for _ in range(2)])
    plain = HeavyKeys("customer_id", twice.schema["customer_id"].dataType, ())
    heavy = heavy_keys(twice, "customer_id", min_rows=10)
    want, got = (sorted((r.transaction_id, r.moving_avg_amount) for r in moving_average(twice, heavy=h, runs=60).collect()) for h in (plain, heavy))
    assert got == want


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 6), st.integers(0, 9)), min_size=8, max_size=40),
       st.integers(2, 9))
def test_any_cut_gives_the_same_frames(spark, drawn, runs):
    data = [(f"t{i:03}", c, float(v), s) for i, (c, s, v) in enumerate(drawn)]
    df = frame(spark, data)
    heavy = heavy_keys(df, "customer_id", min_rows=2)
    got = {r.transaction_id: r.total for r in with_row_frame(
        df, "customer_id", ["timestamp", "transaction_id"], ["amount"], (-3, -1),
        lambda w: {"total": F.sum("amount").over(w)}, heavy=heavy, runs=runs).collect()}
    assert got == {k: (sum(v) if v else None) for k, v in by_brute_force(data, -3, -1).items()}


def test_history_baseline(spark, monkeypatch):
    monkeypatch.setattr(skew, "MIN_ROWS", 20)
    data = [(f"t{i}", "hot", 10.0 + i % 2, i) for i in range(50)] + [("far", "hot", 100.0, 60), ("one", "c", 5.0, 1),
            ("same1", "d", 5.0, 1), ("same2", "d", 5.0, 2), ("none", None, 5.0, 1)]
    got = {r.transaction_id: (r.z_flag, r.z_score) for r in zscore_history(frame(spark, data)).collect()}
    assert len(got) == len(data)
    assert got["far"][0] == 1 and got["t0"][0] == 0
    assert got["one"] == got["same1"] == got["none"] == (0, None)


def test_frame_may_not_look_ahead(spark):
    with pytest.raises(ValueError):
        with_row_frame(frame(spark, rows(5)), "customer_id", ["timestamp"], ["amount"], (0, 1), lambda w: {})
