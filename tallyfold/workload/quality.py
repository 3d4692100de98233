"""Quality suites, offending rows, reports, schema audit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators.clean import standardise_customers, standardise_transactions
from ..operators.schema_audit import audit_schema, file_verdicts
from ..plans.quality import store_quality, suite_results
from ..quality.report import (last_metrics, latest_report, quality_metrics, quality_report, suite_statistics, weekly,
                              with_level, with_message)
from ..quality.rules import CONFIGURED_SUITES, CRM_SUITE, TRANSACTION_SUITE, rules_from_config
from ..quality.suite import offending_rows, rows_with_duplicate_key, run_suite, split_valid
from ..sinks.warehouse import files
from ..sources.files import validation_results
from ..workspace import run_dir
from .tables import CRM_CTES, TX_CTES, crm_raw, table, tx_raw

AS_OF = datetime(2001, 1, 1)
CUSTOMERS, TRANSACTIONS, JOINS = (CONFIGURED_SUITES[name] for name in ("customers", "transactions", "joins"))


def crm(spark, sf_dir):
    return standardise_customers(crm_raw(spark, sf_dir))


def tx(spark, sf_dir):
    return standardise_transactions(tx_raw(spark, sf_dir)).withColumnRenamed("event_ts", "timestamp")


def foreign_key(spark, sf_dir):
    return run_suite(tx(spark, sf_dir), "joins", JOINS, references={"customers": crm(spark, sf_dir)})


def both_suites(spark, sf_dir):
    return suite_results({"crm": crm(spark, sf_dir), "transactions": tx(spark, sf_dir)},
                         {"crm": CRM_SUITE, "transactions": TRANSACTION_SUITE})


def metrics(spark, sf_dir):
    return with_level(quality_metrics(suite_statistics(both_suites(spark, sf_dir))))


def quarantine(spark, sf_dir):
    _, rejected = split_valid(tx(spark, sf_dir), TRANSACTIONS, as_of=AS_OF)
    return rejected.withColumn("failed_rules", F.array_join("failed_rules", ","))


def accepted(spark, sf_dir):
    return split_valid(tx(spark, sf_dir), TRANSACTIONS, as_of=AS_OF)[0]


def gate_by_keys(spark, sf_dir):
    """Rows stopped by the critical rules of two suites, uniqueness and reference rules among them."""
    customers = split_valid(crm(spark, sf_dir), CUSTOMERS, as_of=AS_OF)[1].select(
        F.lit("customers").alias("suite"), F.col("customer_id").alias("id"), "ingest_seq", "failed_rules")
    joins = split_valid(tx(spark, sf_dir), JOINS, references={"customers": crm(spark, sf_dir)})[1].select(
        F.lit("joins").alias("suite"), F.col("transaction_id").alias("id"), "ingest_seq", "failed_rules")
    return customers.unionByName(joins).withColumn("failed_rules", F.array_join("failed_rules", ","))


# Rules as a configuration file holds them.
CONFIGURED = [
    {"type": "expect_column_values_to_not_be_null", "name": "has_id", "column": "transaction_id", "severity": "critical",
     "message": "id"},
    {"type": "expect_column_values_to_be_unique", "name": "one_id", "column": "transaction_id", "severity": "warning",
     "message": "copies"},
    {"type": "expect_column_values_to_be_between", "name": "range", "column": "amount", "severity": "warning",
     "message": "amount", "min_value": 1000, "max_value": 50000},
    {"type": "expect_column_values_to_be_in_set", "name": "paid", "column": "status", "severity": "critical",
     "message": "status", "values": ["SUCCESS", "PENDING"]},
]


def configured(spark, sf_dir):
    return run_suite(tx(spark, sf_dir), "configured", rules_from_config(CONFIGURED))


def offenders(spark, sf_dir):
    rows = offending_rows(tx(spark, sf_dir), [*TRANSACTION_SUITE, *JOINS], references={"customers": crm(spark, sf_dir)})
    return rows.withColumn("failed_rules", F.array_join("failed_rules", ","))


def daily_statistics(spark, sf_dir):
    """Suite statistics of every day's transactions, as a daily run would have stored them."""
    rows = tx(spark, sf_dir).withColumn("run_ts", F.col("timestamp").cast("date"))
    return suite_statistics(run_suite(rows, "transactions", TRANSACTIONS, as_of=AS_OF, by=["run_ts"]), ["run_ts"])


def results_scan(spark, sf_dir):
    """Suite statistics stored as nested JSON, found again under a folder tree, and summed up."""
    root = run_dir(spark, "validations")
    for name, rules, rows in (("crm", CRM_SUITE, crm), ("transactions", TRANSACTION_SUITE, tx)):
        stats = suite_statistics(run_suite(rows(spark, sf_dir), name, rules))
        fields = [c for c in stats.columns if c != "suite"]
        (stats.select(F.struct(F.col("suite").alias("expectation_suite_name")).alias("meta"),
                      F.struct(*fields).alias("statistics")).write.json(f"{root}/{name}/latest"))
    return validation_results(spark, root)


def newest_daily_report(spark, sf_dir):
    daily = quality_metrics(daily_statistics(spark, sf_dir), ["run_ts"])
    stored = daily.withColumn("run_id", F.date_format("run_ts", "yyyyMMdd"))
    return with_message(latest_report(spark, stored), F.col("run_ts"), F.col("run_id"))


def stored_report(spark, sf_dir):
    """One weekly run stored as result and report tables, and the report found again."""
    root = run_dir(spark, "quality")
    store_quality({"crm": crm(spark, sf_dir), "transactions": tx(spark, sf_dir)},
                  {"crm": CRM_SUITE, "transactions": TRANSACTION_SUITE}, files(root), "run-1", AS_OF)
    return latest_report(spark, spark.read.parquet(f"{root}/quality_reports")).drop("run_ts")


def newest_metrics(spark, sf_dir):
    """Metrics of the last day with results, or zeros."""
    daily = quality_metrics(daily_statistics(spark, sf_dir), ["run_ts"])
    return last_metrics(daily.withColumn("run_id", F.date_format("run_ts", "yyyyMMdd")))


# Expected schema of the files of one table; Arrow type names.
CUSTOMER_FIELDS = {"c_custkey": "int", "c_name": "string", "c_nationkey": "INT32", "c_acctbal": "int64", "c_phone": "string"}


def files_audit(spark, sf_dir):
    """Every file in the folder against the customer schema: only the customer files come near it."""
    audit = audit_schema(spark, sf_dir, CUSTOMER_FIELDS)
    name = F.regexp_extract("path", r"/([^/]+)\.parquet", 1)
    # A table may be stored as several files, which all have one schema.
    return audit.select(name.alias("table_name"), "field", "expected", "actual", "verdict").dropDuplicates(
        ["table_name", "field"])


def landed_audit(spark, sf_dir):
    """Customers landed by nation, one file or more each, as the schema drifted: some nations hold keys as text, some
    have no phone. Every file is read by a task; a nation is valid if all its files are. A further row says that an unknown format is refused."""
    root, customers = run_dir(spark, "landed"), table(spark, sf_dir, "customer").withColumn("nation", F.col("c_nationkey"))
    drifts = (lambda rows: rows, lambda rows: rows.withColumn("c_custkey", F.col("c_custkey").cast("string")), lambda rows: rows.drop("c_phone"))
    for number, drift in enumerate(drifts):
        part = customers.where(F.pmod("nation", F.lit(len(drifts))) == number)
        drift(part).hint("rebalance", "nation").write.mode("append").partitionBy("nation").parquet(root)
    nation = F.regexp_extract("path", r"/nation=([^/]+)/", 1).cast("long").alias("nation")
    audit = audit_schema(spark, root, CUSTOMER_FIELDS)
    valid = file_verdicts(audit).groupBy(nation).agg(F.bool_and("valid").alias("valid"))
    found = audit.select(nation, "field", "expected", "actual", "verdict").distinct().join(valid, "nation")
    try:
        audit_schema(spark, root, CUSTOMER_FIELDS, "orc")
        refused = "no"
    except ValueError:
        refused = "yes"
    return found.unionByName(spark.createDataFrame([(None, "orc", None, None, f"refused: {refused}", None)], found.schema))


QUERIES = {
    "quality_crm": lambda spark, sf_dir: run_suite(crm(spark, sf_dir), "crm", CRM_SUITE),
    "quality_tx": lambda spark, sf_dir: run_suite(tx(spark, sf_dir), "transactions", TRANSACTION_SUITE),
    "quality_yaml_customers": lambda spark, sf_dir: run_suite(crm(spark, sf_dir), "customers", CUSTOMERS),
    "quality_yaml_transactions": lambda spark, sf_dir: run_suite(tx(spark, sf_dir), "transactions", TRANSACTIONS,
                                                                 as_of=AS_OF),
    "quality_fk": foreign_key,
    "quality_unique_offenders": lambda spark, sf_dir: rows_with_duplicate_key(tx(spark, sf_dir), "transaction_id"),
    "quality_unique_offenders_large": lambda spark, sf_dir: rows_with_duplicate_key(
        tx(spark, sf_dir), "transaction_id", min_rows=1, broadcast_rows=0),
    "quality_quarantine": quarantine,
    "quality_accepted": accepted,
    "quality_offenders": offenders,
    "quality_gate_keys": gate_by_keys,
    "quality_configured": configured,
    "quality_report": lambda spark, sf_dir: quality_report(suite_statistics(both_suites(spark, sf_dir))),
    "quality_level": metrics,
    "quality_weekly": lambda spark, sf_dir: weekly(daily_statistics(spark, sf_dir)),
    "quality_message": newest_daily_report,
    "validation_results_scan": results_scan,
    "quality_stored": stored_report,
    "quality_last_metrics": newest_metrics,
    "schema_audit": files_audit,
    "schema_audit_landed": landed_audit,
}


def rule_sql(suite, source, rules):
    """One row per rule; each rule is (name, column, severity, message, judged, offending) in SQL."""
    rows = " UNION ALL ".join(
        f"""SELECT {no} AS rule_no, '{name}' AS rule, '{column}' AS "column", '{severity}' AS severity,
        '{message}' AS message, count(*) FILTER ({judged}) AS evaluated, count(*) FILTER ({offending}) AS unexpected
        FROM {source}""" for no, (name, column, severity, message, judged, offending) in enumerate(rules, 1))
    return f"""SELECT '{suite}' AS suite, *, CASE WHEN evaluated > 0 THEN 100.0 * unexpected / evaluated ELSE 0.0 END
        AS unexpected_percent, unexpected = 0 AS success FROM ({rows})"""


def schema_sql(suite, rules):
    """Rules about the schema are judged once; each is (rule_no, name, column, ok)."""
    return " UNION ALL ".join(
        f"""SELECT '{suite}' AS suite, {no} AS rule_no, '{name}' AS rule, '{column}' AS "column", 'critical' AS severity,
        '' AS message, 1 AS evaluated, {0 if ok else 1} AS unexpected, {0.0 if ok else 100.0} AS unexpected_percent,
        {str(ok).lower()} AS success""" for no, name, column, ok in rules)


def plain(name, column, judged, offending):
    return name, column, "critical", "", judged, offending


LOOSE_EMAIL = r"^[^@]+@[^@]+\.[^@]+"
STRICT_EMAIL = r"^[\w\.-]+@[\w\.-]+\.\w+$"
CRM_ROWS = [
    plain("not_null_customer_id", "customer_id", "true", "customer_id IS NULL"),
    plain("unique_customer_id", "customer_id", "customer_id IS NOT NULL", "customer_id IS NOT NULL AND copies > 1"),
    plain("matches_regex_email", "email", "email IS NOT NULL", f"NOT regexp_matches(email, '{LOOSE_EMAIL}')"),
    plain("between_age", "age", "age IS NOT NULL", "age < 18 OR age > 100"),
]
TX_ROWS = [
    plain("not_null_transaction_id", "transaction_id", "true", "transaction_id IS NULL"),
    plain("unique_transaction_id", "transaction_id", "transaction_id IS NOT NULL",
          "transaction_id IS NOT NULL AND copies > 1"),
    plain("between_amount", "amount", "amount IS NOT NULL", "amount < 0 OR amount > 100000"),
    plain("matches_regex_currency", "currency", "currency IS NOT NULL", "NOT regexp_matches(currency, '^[A-Z]{3}$')"),
    plain("in_set_status", "status", "status IS NOT NULL", "status NOT IN ('SUCCESS', 'FAILED', 'PENDING')"),
]
CUSTOMER_ROWS = [
    ("no_null_customer_id", "customer_id", "critical",
     "Le champ customer_id ne doit pas contenir de valeurs nulles.", "true", "customer_id IS NULL"),
    ("unique_customer_id", "customer_id", "critical",
     "Les identifiants clients doivent être uniques.", "customer_id IS NOT NULL",
     "customer_id IS NOT NULL AND copies > 1"),
    ("valid_email_format", "email", "warning",
     "Certaines adresses email ne respectent pas le format valide.", "email IS NOT NULL",
     f"NOT regexp_matches(email, '{STRICT_EMAIL}')"),
    ("valid_age_range", "age", "warning",
     "Âge du client en dehors de la plage autorisée (18-99).", "age IS NOT NULL", "age < 18 OR age > 99"),
]
TRANSACTION_ROWS = [
    ("no_null_transaction_id", "transaction_id", "critical",
     "Le champ transaction_id ne doit pas contenir de valeurs nulles.", "true", "transaction_id IS NULL"),
    ("positive_amount", "amount", "critical",
     "Montant de transaction invalide (négatif ou supérieur à 100000).", "amount IS NOT NULL",
     "amount < 0 OR amount > 100000"),
    ("valid_currency", "currency", "warning",
     "Certaines devises ne sont pas reconnues.", "currency IS NOT NULL",
     "currency NOT IN ('USD', 'EUR', 'MAD')"),
    ("timestamp_not_future", "timestamp", "warning",
     "Certaines transactions datent du futur (erreur horodatage).", "event_ts IS NOT NULL",
     "event_ts >= TIMESTAMP '2001-01-01'"),
]
JOIN_ROWS = [("foreign_key_customer_exists", "customer_id", "critical",
     "Des transactions contiennent un customer_id inexistant dans la base CRM.", "customer_id IS NOT NULL",
              "customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM crm_std)")]

COUNTED = """crm_counted AS (SELECT *, count(*) OVER (PARTITION BY customer_id) AS copies FROM crm_std),
tx_counted AS (SELECT *, count(*) OVER (PARTITION BY transaction_id) AS copies FROM tx_std)"""
_WITH = f"WITH {CRM_CTES}, {TX_CTES}, {COUNTED}"


def renumbered(sql, numbers):
    """Rule numbers of the whole suite for the rules that look at rows."""
    cases = " ".join(f"WHEN {i} THEN {no}" for i, no in enumerate(numbers, 1))
    return f"SELECT * REPLACE (CASE rule_no {cases} END AS rule_no) FROM ({sql})"


_CRM_RESULTS = renumbered(rule_sql("crm", "crm_counted", CRM_ROWS), (3, 4, 5, 7)) + " UNION ALL BY NAME " + schema_sql(
    "crm", [(1, "column_exists_customer_id", "customer_id", True), (2, "column_exists_email", "email", True),
            (6, "of_type_age", "age", True)])
_TX_RESULTS = renumbered(rule_sql("transactions", "tx_counted", TX_ROWS), (4, 5, 7, 8, 9)) + " UNION ALL BY NAME " + schema_sql(
    "transactions", [(1, "column_exists_transaction_id", "transaction_id", True),
                     (2, "column_exists_customer_id", "customer_id", True), (3, "column_exists_amount", "amount", True),
                     (6, "of_type_amount", "amount", True)])
STATISTICS = f"""{_WITH}, results AS ({_CRM_RESULTS} UNION ALL BY NAME {_TX_RESULTS}),
statistics AS (SELECT suite, count(*) AS evaluated_expectations,
    count(*) FILTER (success) AS successful_expectations, count(*) FILTER (NOT success) AS unsuccessful_expectations,
    100.0 * count(*) FILTER (success) / count(*) AS success_percent FROM results GROUP BY suite)"""


def level_sql(rate):
    return f"CASE WHEN {rate} >= 95 THEN 'Excellent' WHEN {rate} >= 80 THEN 'Moyen' ELSE 'Critique' END"


_METRICS = """SELECT round(avg(success_percent), 2) AS global_success_rate,
    CAST(sum(evaluated_expectations) AS BIGINT) AS total_checks,
    CAST(sum(unsuccessful_expectations) AS BIGINT) AS total_failures"""

_FAILED = {
    "not_null_transaction_id": "transaction_id IS NULL",
    "unique_transaction_id": "transaction_id IS NOT NULL AND copies > 1",
    "between_amount": "amount < 0 OR amount > 100000",
    "matches_regex_currency": "NOT regexp_matches(currency, '^[A-Z]{3}$')",
    "in_set_status": "status NOT IN ('SUCCESS', 'FAILED', 'PENDING')",
    "foreign_key_customer_exists": "customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM crm_std)",
}
_GATE = {"no_null_transaction_id": "transaction_id IS NULL", "positive_amount": "amount < 0 OR amount > 100000"}
_TX_COLUMNS = """transaction_id, customer_id, amount, transaction_date, currency, status, event_ts AS "timestamp",
    ingest_seq, is_valid"""


def failed_sql(rules):
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in rules.items()) + ")"


_DAILY = f"""{_WITH}, daily AS (
    SELECT CAST(event_ts AS DATE) AS run_ts, count(*) FILTER (transaction_id IS NULL) AS r1,
      count(*) FILTER (amount < 0 OR amount > 100000) AS r2, count(*) FILTER (currency NOT IN ('USD', 'EUR', 'MAD')) AS r3,
      count(*) FILTER (event_ts >= TIMESTAMP '2001-01-01') AS r4
    FROM tx_std GROUP BY 1),
statistics AS (SELECT run_ts, 4 AS evaluated_expectations,
    CAST(r1 > 0 AS INT) + CAST(r2 > 0 AS INT) + CAST(r3 > 0 AS INT) + CAST(r4 > 0 AS INT) AS unsuccessful_expectations,
    25.0 * (4 - unsuccessful_expectations) AS success_percent FROM daily)"""

_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
           "conversations").split()
_ACTUAL = " UNION ALL ".join(f"SELECT '{t}' AS table_name, column_name AS field, column_type FROM (DESCRIBE {t})" for t in _TABLES)
_EXPECTED = ", ".join(f"('{field}', '{dtype}')" for field, dtype in CUSTOMER_FIELDS.items())

ORACLES = {
    "schema_audit_landed": f"""WITH fields AS (
        SELECT column_name AS field, CASE column_type WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'VARCHAR' THEN 'string'
          ELSE lower(column_type) END AS arrow_type FROM (DESCRIBE customer)),
      nations AS (SELECT DISTINCT c_nationkey AS nation FROM customer),
      actual AS (SELECT nation, field, CASE WHEN nation % 3 = 1 AND field = 'c_custkey' THEN 'string' ELSE arrow_type END AS actual
        FROM nations, fields WHERE NOT (nation % 3 = 2 AND field = 'c_phone')),
      wanted AS (SELECT nation, field, expected FROM nations, (VALUES {_EXPECTED}) v(field, expected)),
      judged AS (SELECT coalesce(w.nation, a.nation) AS nation, coalesce(w.field, a.field) AS field, expected, actual,
          CASE WHEN actual IS NULL THEN 'missing' WHEN expected IS NULL THEN 'extra'
            WHEN contains(lower(actual), lower(expected)) THEN 'ok' ELSE 'mismatch' END AS verdict
        FROM wanted w FULL OUTER JOIN actual a ON w.nation = a.nation AND w.field = a.field)
      SELECT CAST(nation AS BIGINT) AS nation, field, expected, actual, verdict,
        bool_and(verdict IN ('ok', 'extra')) OVER (PARTITION BY nation) AS valid FROM judged
      UNION ALL VALUES (NULL, 'orc', NULL, NULL, 'refused: yes', NULL)""",
    "schema_audit": f"""WITH actual AS (
        SELECT *, CASE column_type WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'VARCHAR' THEN 'string'
          WHEN 'TIMESTAMP' THEN 'timestamp[us]' WHEN 'FLOAT[]' THEN 'list<element: float>'
          ELSE lower(column_type) END AS arrow_type FROM ({_ACTUAL})),
      wanted AS (SELECT table_name, field, expected FROM (SELECT DISTINCT table_name FROM actual),
        (VALUES {_EXPECTED}) v(field, expected))
      SELECT coalesce(w.table_name, a.table_name) AS table_name, coalesce(w.field, a.field) AS field, expected,
        arrow_type AS actual, CASE WHEN arrow_type IS NULL THEN 'missing' WHEN expected IS NULL THEN 'extra'
          WHEN contains(arrow_type, lower(expected)) THEN 'ok' ELSE 'mismatch' END AS verdict
      FROM wanted w FULL OUTER JOIN actual a ON w.table_name = a.table_name AND w.field = a.field""",
    "quality_crm": f"{_WITH} {_CRM_RESULTS}",
    "quality_tx": f"{_WITH} {_TX_RESULTS}",
    "quality_yaml_customers": f"{_WITH} {rule_sql('customers', 'crm_counted', CUSTOMER_ROWS)}",
    "quality_yaml_transactions": f"{_WITH} {rule_sql('transactions', 'tx_counted', TRANSACTION_ROWS)}",
    "quality_fk": f"{_WITH} {rule_sql('joins', 'tx_std', JOIN_ROWS)}",
    "quality_unique_offenders": f"""{_WITH} SELECT {_TX_COLUMNS}, copies AS occurrences FROM tx_counted
        WHERE transaction_id IS NOT NULL AND copies > 1""",
    "quality_unique_offenders_large": f"""{_WITH} SELECT {_TX_COLUMNS}, copies AS occurrences FROM tx_counted
        WHERE transaction_id IS NOT NULL AND copies > 1""",
    "quality_quarantine": f"""{_WITH} SELECT {_TX_COLUMNS}, {failed_sql(_GATE)} AS failed_rules FROM tx_std
        WHERE failed_rules <> ''""",
    "quality_accepted": f"""{_WITH} SELECT {_TX_COLUMNS} FROM tx_std
        WHERE transaction_id IS NOT NULL AND (amount IS NULL OR amount BETWEEN 0 AND 100000)""",
    "quality_configured": _WITH + rule_sql("configured", "tx_counted", [
        ("has_id", "transaction_id", "critical", "id", "true", "transaction_id IS NULL"),
        ("one_id", "transaction_id", "warning", "copies", "transaction_id IS NOT NULL", "transaction_id IS NOT NULL AND copies > 1"),
        ("range", "amount", "warning", "amount", "amount IS NOT NULL", "amount < 1000 OR amount > 50000"),
        ("paid", "status", "critical", "status", "status IS NOT NULL", "status NOT IN ('SUCCESS', 'PENDING')")]),
    "quality_gate_keys": f"""{_WITH} SELECT 'customers' AS suite, customer_id AS id, ingest_seq,
        concat_ws(',', CASE WHEN customer_id IS NULL THEN 'no_null_customer_id' END,
                  CASE WHEN customer_id IS NOT NULL AND copies > 1 THEN 'unique_customer_id' END) AS failed_rules
        FROM crm_counted WHERE failed_rules <> ''
        UNION ALL SELECT 'joins', transaction_id, ingest_seq, 'foreign_key_customer_exists' FROM tx_std
        WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM crm_std)""",
    "quality_offenders": f"""{_WITH} SELECT {_TX_COLUMNS}, {failed_sql(_FAILED)} AS failed_rules FROM tx_counted
        WHERE failed_rules <> ''""",
    "quality_report": f"""{STATISTICS} SELECT suite, success_percent, evaluated_expectations, unsuccessful_expectations,
        {level_sql('success_percent')} AS level FROM statistics
        UNION ALL SELECT 'TOTAL', global_success_rate, total_checks, total_failures, {level_sql('global_success_rate')}
        FROM ({_METRICS} FROM statistics)""",
    "quality_level": f"""{STATISTICS} SELECT *, {level_sql('global_success_rate')} AS level
        FROM ({_METRICS} FROM statistics)""",
    "quality_stored": f"""{STATISTICS} SELECT *, {level_sql('global_success_rate')} AS level, 'run-1' AS run_id
        FROM ({_METRICS} FROM statistics)""",
    "quality_last_metrics": f"""{_DAILY} {_METRICS} FROM statistics
        WHERE run_ts = (SELECT max(run_ts) FROM statistics)""",
    "quality_weekly": f"""{_DAILY} SELECT *, {level_sql('global_success_rate')} AS level FROM (
        {_METRICS}, CAST(date_trunc('week', run_ts) AS DATE) AS week FROM statistics GROUP BY week)""",
    "quality_message": f"""{_DAILY} SELECT * EXCLUDE (level), CASE level WHEN 'Excellent' THEN '✅' WHEN 'Moyen' THEN '⚠️' ELSE '❌' END
          || ' *Rapport de Qualité - ' || CAST(run_ts AS VARCHAR) || '*' || chr(10)
          || '**Taux global de succès :** ' || CAST(global_success_rate AS VARCHAR) || '%' || chr(10)
          || '**Statut :** ' || level || chr(10)
          || '**Total de contrôles :** ' || CAST(total_checks AS VARCHAR) || chr(10)
          || '**Échecs :** ' || CAST(total_failures AS VARCHAR) || chr(10) || chr(10)
          || '🗂 Rapport : ' || run_id AS message
        FROM (SELECT *, {level_sql('global_success_rate')} AS level FROM (
          {_METRICS}, run_ts, strftime(run_ts, '%Y%m%d') AS run_id FROM statistics GROUP BY run_ts)
          ORDER BY run_ts DESC LIMIT 1)""",
    "validation_results_scan": f"{STATISTICS} SELECT * FROM statistics",
}
