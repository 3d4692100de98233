from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import skew
from tallyfold.operators.enrich import join_customers, orphan_keys
from tallyfold.operators.skew import (HeavyKeys, aggregate_keys, flagged_keys, heavy_keys, lookup_left_join,
                                      salted_left_join)


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def left(spark):
    """A third of the rows has key h, a third has none; many rows are exact copies."""
    return spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "h").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("v")).cache()


@pytest.fixture(scope="module")
def right(spark):
    return spark.range(0, 900, 2).select(F.when(F.col("id") == 0, "h").otherwise(F.col("id").cast("string")).alias("k"),
                                         (F.col("id") * 10).alias("w"))


def test_measure(spark, left):
    heavy = heavy_keys(left, "k", shares=100, min_rows=10)
    assert sorted(heavy.rows, key=str) == [("h", 30), (None, 30)]
    assert not heavy_keys(left, "k", min_rows=301)
    assert not heavy_keys(left.where("1 = 0"), "k", min_rows=1)


def test_number_of_heavy_keys_is_bounded(spark):
    even = spark.range(1000).select((F.col("id") % 100).alias("k"))
    assert len(heavy_keys(even, "k", shares=50, min_rows=1).rows) < 50


def test_salted_join_equals_the_plain_one(spark, left, right):
    want = bag(left.join(right, "k", "left"))
    for heavy in (heavy_keys(left, "k", shares=100, min_rows=10), HeavyKeys("k", left.schema["k"].dataType, ())):
        got = salted_left_join(left, right, heavy, F.xxhash64("v"))
        assert got.columns == ["k", "v", "w"]
        assert bag(got) == want


@pytest.mark.parametrize("min_rows, broadcast_rows", [(10, 0), (10, 1000), (1000, 0), (1000, 1000)])
def test_aggregates_joined_back(spark, left, monkeypatch, min_rows, broadcast_rows):
    monkeypatch.setattr(skew, "MIN_ROWS", min_rows)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", broadcast_rows)
    keys = aggregate_keys(left, "k", top=F.max("v"))
    assert bool(keys.heavy) == (min_rows == 10) and keys.small == (broadcast_rows == 1000)
    plain = left.groupBy("k").agg(F.count("*").alias("occurrences"), F.max("v").alias("top"))
    assert bag(lookup_left_join(left, keys)) == bag(left.join(plain, "k", "left"))


@pytest.mark.parametrize("min_rows, broadcast_rows", [(10, 0), (10, 1000), (1000, 0), (1000, 1000)])
def test_flags_joined_back(spark, left, monkeypatch, min_rows, broadcast_rows):
    monkeypatch.setattr(skew, "MIN_ROWS", min_rows)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", broadcast_rows)
    keys = flagged_keys(left, "k", lambda counts: counts.withColumn("_flag", F.col("k").like("%5")))
    got = lookup_left_join(left, keys)
    assert got.count() == 900
    assert bag(got.where("occurrences is not null").select("k")) == bag(left.where("k like '%5'").select("k"))


def test_salted_join_with_several_partners(spark, left, right):
    twice = right.unionByName(right.withColumn("w", F.col("w") + 1))
    heavy = heavy_keys(left, "k", shares=100, min_rows=10)
    assert bag(salted_left_join(left, twice, heavy, F.xxhash64("v"))) == bag(left.join(twice, "k", "left"))


def test_heavy_key_reaches_many_tasks(spark):
    left = spark.range(40000).select(F.lit("h").alias("k"), "id")
    right = spark.createDataFrame([("h", 1)], "k string, w int")
    heavy = heavy_keys(left, "k", shares=100, min_rows=10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_left_join(left, right, heavy, F.xxhash64("id"))
        per_task = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(per_task) == 40000 and len(per_task) == 8 and max(per_task) < 12000


def test_lookup_join_leaves_heavy_rows_where_they_are(spark, left, monkeypatch):
    monkeypatch.setattr(skew, "MIN_ROWS", 10)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    plan = lookup_left_join(left, aggregate_keys(left, "k"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_join_customers_renames_and_keeps_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "MIN_ROWS", 5)
    tx = spark.range(60).select(F.concat(F.lit("t"), "id").alias("transaction_id"),
                                F.when(F.col("id") < 40, "1").when(F.col("id") < 50, "9").alias("customer_id"),
                                F.lit("SUCCESS").alias("status"))
    crm = spark.createDataFrame([("1", "active", 30), ("2", "active", 31)], "customer_id string, status string, age int")
    got = join_customers(tx, crm)
    assert got.columns == ["customer_id", "transaction_id", "status", "crm_status", "age", "etl_timestamp"]
    assert got.count() == 60 and got.where("age = 30").count() == 40 and got.where("age is null").count() == 20


def test_orphans_are_counted_before_the_join(spark, left, right):
    got = {r.k: r.occurrences for r in orphan_keys(left, "k", right, "k").table.collect()}
    assert "h" not in got and None not in got
    assert sum(got.values()) == 150
