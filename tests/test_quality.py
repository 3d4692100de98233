from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyfold.functions.alerts import quality_level
from tallyfold.operators import skew
from tallyfold.quality.report import (concat_results, last_metrics, latest_report, quality_metrics, quality_report,
                                      stamp_run, suite_statistics, weekly, with_level, with_message)
from tallyfold.quality.rules import CONFIGURED_SUITES, CRM_SUITE, TRANSACTION_SUITE, Rule, rules_from_config
from tallyfold.quality.suite import offending_rows, rows_with_duplicate_key, run_suite, split_valid


@pytest.fixture(scope="module")
def crm(spark):
    return spark.createDataFrame([(1, "a@test.com", 25), (2, "b@test.com", 30), (3, "invalid-email", 150)],
                                 "customer_id long, email string, age long")


@pytest.fixture(scope="module")
def tx(spark):
    return spark.createDataFrame(
        [("t1", 1, 100.0, "USD", "SUCCESS"), ("t2", 2, -5.0, "EUR", "FAILED"), ("t3", 3, 200.0, "BAD", "PENDING")],
        "transaction_id string, customer_id long, amount double, currency string, status string")


@pytest.fixture(scope="module")
def statistics(crm, tx):
    return suite_statistics(concat_results([run_suite(crm, "crm", CRM_SUITE), run_suite(tx, "tx", TRANSACTION_SUITE)]))


def test_worked_example(crm, tx, statistics):
    assert {r.rule for r in run_suite(crm, "crm", CRM_SUITE).collect() if not r.success} == {"matches_regex_email", "between_age"}
    assert {r.rule for r in run_suite(tx, "tx", TRANSACTION_SUITE).collect() if not r.success} == {"between_amount"}
    got = {r.suite: r for r in statistics.collect()}
    assert (got["crm"].successful_expectations, got["crm"].evaluated_expectations) == (5, 7)
    assert got["crm"].success_percent == pytest.approx(71.4285714)
    assert (got["tx"].successful_expectations, got["tx"].unsuccessful_expectations) == (8, 1)
    total = with_level(quality_metrics(statistics)).first()
    assert tuple(total) == (80.16, 16, 3, "Moyen")


def test_report_has_a_total_row(statistics):
    got = {r.suite: r for r in quality_report(statistics).collect()}
    assert got.keys() == {"crm", "tx", "TOTAL"}
    assert (got["TOTAL"].success_percent, got["TOTAL"].level, got["crm"].level) == (80.16, "Moyen", "Critique")


def test_no_results(statistics):
    assert tuple(with_level(quality_metrics(statistics.where("1 = 0"))).first()) == (0.0, 0, 0, "Critique")


@pytest.mark.parametrize("rate, level", [(100.0, "Excellent"), (95.0, "Excellent"), (94.99, "Moyen"), (80.0, "Moyen"),
                                         (79.99, "Critique"), (0.0, "Critique"), (None, "Critique")])
def test_levels(spark, rate, level):
    assert spark.createDataFrame([(rate,)], "r double").select(quality_level(F.col("r"))).first()[0] == level


def test_message(statistics):
    text = with_message(quality_metrics(statistics), F.lit("2025-10-14"), F.lit("r1")).first().message
    assert text.splitlines() == [
        "⚠️ *Rapport de Qualité - 2025-10-14*", "**Taux global de succès :** 80.16%", "**Statut :** Moyen",
        "**Total de contrôles :** 16", "**Échecs :** 3", "", "🗂 Rapport : r1"]


def test_missing_column_fails_the_rule_only(spark):
    df = spark.createDataFrame([(1,)], "customer_id long")
    got = {r.rule_no: r for r in run_suite(df, "crm", CRM_SUITE).collect()}
    assert len(got) == 7
    assert [no for no, r in sorted(got.items()) if r.success] == [1, 3, 4]
    assert got[7].message == "column is missing" and got[7].evaluated == 0


def test_nulls_are_not_judged_except_by_not_null(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "a long, b string")
    rules = [Rule("not_null", "a"), Rule("unique", "a"), Rule("between", "a", low=0, high=1), Rule("in_set", "b", values=("x",)),
             Rule("matches_regex", "b", pattern="x"), Rule("less_than", "a", limit=1)]
    got = [(r.evaluated, r.unexpected, r.success) for r in run_suite(df, "s", rules).orderBy("rule_no").collect()]
    assert got == [(2, 2, False)] + [(0, 0, True)] * 5


def test_nan_is_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "a double")
    got = run_suite(df, "s", [Rule("not_null", "a"), Rule("between", "a", low=0, high=2)]).orderBy("rule_no").collect()
    assert [(r.evaluated, r.unexpected) for r in got] == [(3, 2), (1, 0)]


def test_boundaries_and_anchor(spark):
    df = spark.createDataFrame([(0.0, "@a@b.c"), (100.0, "a@b.c x"), (100.1, "é@b.c")], "a double, e string")
    rules = [Rule("between", "a", low=0, high=100), Rule("less_than", "a", limit=100.0),
             Rule("matches_regex", "e", pattern=r"[^@]+@[^@]+\.[^@]+"), Rule("matches_regex", "e", pattern=r"^[\w\.-]+@[\w\.-]+\.\w+$")]
    assert [r.unexpected for r in run_suite(df, "s", rules).orderBy("rule_no").collect()] == [1, 2, 1, 3]


def test_text_amounts_that_are_no_numbers_are_outside(spark):
    df = spark.createDataFrame([("abc",), ("5",), (None,)], "amount string")
    row = run_suite(df, "s", [Rule("between", "amount", low=0, high=10)]).first()
    assert (row.evaluated, row.unexpected) == (2, 1)


def test_types(spark):
    df = spark.createDataFrame([(1, 1.0)], "a int, b double")
    got = run_suite(df, "s", [Rule("of_type", "a", type_name="int64"), Rule("of_type", "b", type_name="float64")])
    assert [r.success for r in got.orderBy("rule_no").collect()] == [False, True]


def test_unique_counts_every_copy(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    row = run_suite(df, "s", [Rule("unique", "k")]).first()
    assert (row.evaluated, row.unexpected, row.success) == (3, 2, False)


def test_time_limit_now(spark):
    df = spark.sql("select timestamp'2000-01-01 00:00:00' t union all select timestamp'2999-01-01 00:00:00'")
    rule = CONFIGURED_SUITES["transactions"][3]
    rules = [Rule(rule.kind, "t", limit=rule.limit)]
    assert run_suite(df, "s", rules).first().unexpected == 1
    assert run_suite(df, "s", rules, as_of=datetime(2000, 1, 1)).first().unexpected == 2


def test_groups(spark):
    df = spark.createDataFrame([("d1", "a"), ("d1", "a"), ("d2", "a"), ("d2", None)], "day string, k string")
    got = {(r.day, r.rule): r.unexpected for r in run_suite(df, "s", [Rule("not_null", "k"), Rule("unique", "k")], by=["day"]).collect()}
    assert got == {("d1", "not_null_k"): 0, ("d1", "unique_k"): 2, ("d2", "not_null_k"): 1, ("d2", "unique_k"): 0}


def test_row_rules_share_one_aggregate(tx):
    rules = [r for r in TRANSACTION_SUITE if r.kind != "unique"]
    plan = run_suite(tx, "tx", rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_rules_from_config():
    rules = rules_from_config([
        {"name": "n", "type": "expect_column_values_to_be_in_set", "column": "c", "values": ["x"], "severity": "warning", "message": "m"},
        {"type": "expect_column_values_to_be_between", "column": "c", "min_value": 1, "max_value": 2}])
    assert rules == [Rule("in_set", "c", "n", "warning", "m", values=("x",)), Rule("between", "c", low=1, high=2)]
    with pytest.raises(ValueError):
        Rule("unheard_of", "c")
    with pytest.raises(ValueError):
        Rule("unique", "c", severity="fatal")


def test_quarantine(tx):
    valid, rejected = split_valid(tx, CONFIGURED_SUITES["transactions"][:3])
    assert sorted(r.transaction_id for r in valid.collect()) == ["t1", "t3"]
    assert [(r.transaction_id, r.failed_rules) for r in rejected.collect()] == [("t2", ["positive_amount"])]


@pytest.mark.parametrize("min_rows, broadcast_rows", [(2, 0), (2, 1000), (1000, 0), (1000, 1000)])
def test_offenders_with_and_without_heavy_keys(spark, monkeypatch, min_rows, broadcast_rows):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(skew, "MIN_ROWS", min_rows)
    rows = [("dup", 9)] * 5 + [("a", 1), ("b", 9), ("c", None), (None, 1), (None, 9), (None, 9)]
    df = spark.createDataFrame(rows, "transaction_id string, customer_id long")
    rules = [Rule("not_null", "transaction_id", "n"), Rule("unique", "transaction_id", "u"),
             Rule("exists_in", "customer_id", "f", reference_table="crm", reference_column="id")]
    crm = spark.createDataFrame([(1,), (1,), (None,)], "id long")
    got = sorted((r.transaction_id or "", r.customer_id, tuple(r.failed_rules))
                 for r in offending_rows(df, rules, references={"crm": crm}).collect())
    assert got == [("", 1, ("n",)), ("", 9, ("n", "f")), ("", 9, ("n", "f")), ("b", 9, ("f",))] + [("dup", 9, ("u", "f"))] * 5
    assert rows_with_duplicate_key(df, "transaction_id").count() == 5


def test_stored_metrics(spark, statistics):
    early, late = (stamp_run(quality_metrics(statistics.where(f"suite = '{s}'")), s, t) for s, t in
                   (("tx", datetime(2025, 1, 6)), ("crm", datetime(2025, 1, 12))))
    stored = early.unionByName(late)
    assert latest_report(spark, stored).first().run_id == "crm"
    assert tuple(last_metrics(stored).first()) == (71.43, 7, 2)
    assert tuple(last_metrics(stored.where("1 = 0")).first()) == (0.0, 0, 0)
    with pytest.raises(Exception, match="no quality report"):
        latest_report(spark, stored.where("1 = 0")).collect()


def test_weeks_start_on_monday(spark):
    rows = [("2025-01-06", 100.0, 4, 0), ("2025-01-12", 50.0, 4, 2), ("2025-01-13", 75.0, 4, 1)]
    stored = spark.createDataFrame(rows, "d string, success_percent double, evaluated_expectations long, unsuccessful_expectations long")
    got = {str(r.week): (r.global_success_rate, r.total_failures, r.level)
           for r in weekly(stored.withColumn("run_ts", F.to_timestamp("d"))).collect()}
    assert got == {"2025-01-06": (75.0, 2, "Critique"), "2025-01-13": (75.0, 1, "Critique")}
