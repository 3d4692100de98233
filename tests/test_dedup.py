import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyfold.operators.dedup import dedup_by_key, duplicate_keys

ROWS = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "w"), ("b", 1, None), (None, 1, "p"), (None, 5, "q")]


def table(spark):
    return spark.createDataFrame(ROWS, "k string, seq int, v string")


@pytest.mark.parametrize("null_keys, extra", [("collapse", [(None, 5, "q")]), ("drop", []),
                                              ("keep", [(None, 1, "p"), (None, 5, "q")])])
def test_newest_row_is_kept(spark, null_keys, extra):
    got = dedup_by_key(table(spark), ["k"], [F.col("seq").desc()], null_keys).collect()
    assert {tuple(r) for r in got} == {("a", 2, "w"), ("b", 1, None), *extra}
    assert len(got) == 2 + len(extra)


def test_pick_does_not_depend_on_layout(spark):
    picks = {tuple(sorted(map(str, dedup_by_key(table(spark).repartition(n), ["k"]).collect()))) for n in (1, 3, 7)}
    assert len(picks) == 1


def test_rows_are_reduced_before_the_shuffle(spark):
    plan = dedup_by_key(table(spark), ["k"], [F.col("seq").desc()])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > exchange


def test_map_columns_do_not_matter(spark):
    df = spark.sql("select 1 k, map('a', 1) m union all select 1, map('b', 2)")
    assert dedup_by_key(df, ["k"]).count() == 1


def test_unknown_null_mode(spark):
    with pytest.raises(ValueError):
        dedup_by_key(table(spark), ["k"], null_keys="ignore")


def test_duplicate_keys(spark):
    assert [tuple(r) for r in duplicate_keys(table(spark), "k").collect()] == [("a", 3)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.sampled_from(["x", "y", None])), max_size=25),
       st.integers(1, 5))
def test_against_brute_force(spark, data, partitions):
    def rank(row):
        return -row[1], row[2] is not None, row[2] or ""

    want = {min((r for r in data if r[0] == k), key=rank) for k in {r[0] for r in data}}
    df = spark.createDataFrame(data, "k string, seq int, v string").repartition(partitions)
    got = [tuple(r) for r in dedup_by_key(df, ["k"], [F.col("seq").desc()]).collect()]
    assert len(got) == len(want) and set(got) == want


def test_the_pick_is_the_same_without_a_limit_before_the_shuffle(spark):
    rows = [(k, v, w) for k in (1, 2, None) for v in (3, 1, 3, None) for w in ("b", "a", None)]
    df = spark.createDataFrame(rows, "k int, v int, w string")
    for null_keys in ("collapse", "keep", "drop"):
        limited, plain = (dedup_by_key(df, ["k"], [F.col("v").desc()], null_keys, repeated=r) for r in (True, False))
        assert sorted(map(str, plain.collect())) == sorted(map(str, limited.collect()))
        assert "WindowGroupLimit" not in plain._jdf.queryExecution().executedPlan().toString()
