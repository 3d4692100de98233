"""Targets against the rule as it is stated, and edge cases."""

import pytest
from pyspark.sql import functions as F

from tallyfold.llm import mixing

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute_targets(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    limit = {s: 2 * sizes[s] for s in names}
    wanted, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        if not free:
            return limit
        left = wanted - sum(limit[s] for s in full)
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > limit[s]}
        if not over:
            return target | {s: limit[s] for s in full}
        full |= over


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10, None: 10}, {"a": 1, "b": 2, "c": 300}, {"a": 500, "b": 1, "c": 1, "d": 1, "e": 40},
    {"a": 0, "b": 7}, {"only": 12}, {f"s{i}": (i * 37) % 11 + 1 for i in range(25)},
])
def test_targets_and_words_taken(spark, sizes):
    rows = [(i * 100 + k, " ".join(["w"] * (n // 3 + (k < n % 3))), None, s, None)
            for i, (s, n) in enumerate(sizes.items()) for k in range(3)]
    got = mixing.plan_mix(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute_targets(sizes)
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert mine[0]["target"] == pytest.approx(want[s])
        assert sum(r["taken"] for r in mine) == pytest.approx(want[s], abs=1)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert all(0 <= p <= 1 for r in got for p in r["positions"])


def test_null_empty_repeated_and_clashing_columns(spark):
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (None, "x y", None, None, 3), (3, "x y z", "en", "a", 5),
            (3, "x y z", "en", "a", 5)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(9) for c in ("size", "target", "_bucket", "taken")})
    got = mixing.report(docs)
    assert got.count() == 5 and got.where("size = 0 and taken = 0 and position is null").count() == 2
    order = mixing.training_order(docs)
    assert order.agg(F.sum("words")).first()[0] == got.agg(F.sum("taken")).first()[0]


def test_empty_table(spark):
    assert mixing.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_heavy_sources_come_early(spark):
    rows = [(i, "a b c d", None, s, None) for i in range(600) for s in "abc"]
    got = mixing.training_order(spark.createDataFrame([(i * 3 + "abc".index(r[3]), *r[1:]) for i, r in enumerate(rows)], SCHEMA))
    mean = {r[0]: r[1] for r in got.groupBy("source").agg(F.avg("position")).collect()}
    assert mean["a"] < mean["b"] < mean["c"]


def test_the_report_is_that_of_the_written_mix(spark):
    rows = [(i, "a b c d", None, "b" if i < 30 else "a", None) for i in range(40)] + [(41, "", None, "a", None)]
    docs = spark.createDataFrame(rows + rows[:2], SCHEMA)
    got = mixing.documents_of_mix(docs).collect()
    copies = mixing.training_order(docs).collect()
    assert max(len(r.positions) for r in got) == 2 and min(len(r.positions) for r in got) == 0
    assert sorted((r.doc_id, p) for r in got for p in r.positions) == sorted((r.doc_id, r.position) for r in copies)
    assert all(r.position == (r.positions[0] if r.positions else None) for r in got)
    _, mix = mixing.written_mix(docs)
    parts = [r.position for r in mix.withColumn("_f", F.input_file_name()).withColumn("_at", F.monotonically_increasing_id())
             .orderBy("_f", "_at").collect()]
    assert parts == sorted(parts) and len(parts) == len(copies)
