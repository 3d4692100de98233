"""Cleaning, joining, extracting, landing."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import cleaning as c
from ..operators.clean import (clean_customers, clean_transactions, mask_customers, normalise_names,
                               standardise_customers, standardise_transactions)
from ..operators.dedup import duplicate_keys
from ..operators.skew import heavy_keys
from ..plans.batch import joined_transactions, run_batch
from ..schemas import LOAD_AUDIT, RAW_CUSTOMER
from ..sinks import warehouse
from ..sinks.audit import TooManyBadRecords, audited_save, check_bad_records, prune_audit, read_audit
from ..sinks.layout import land_extract
from ..sources.files import day_before, json_records
from ..sources.spec import read_source
from ..workspace import run_dir
from .tables import CRM_CTES, TX_CTES, crm_raw, table, tx_raw

RUN_DAY = date(1998, 9, 2)
RUN_TS = datetime(2001, 1, 1, 6, 30)


def newest_first():
    return [F.col("ingest_seq").desc_nulls_last()]


def batch_joined(spark, sf_dir):
    joined = joined_transactions(tx_raw(spark, sf_dir), crm_raw(spark, sf_dir), latest_first=newest_first())
    return joined.drop("etl_timestamp")


def batch_joined_split(spark, sf_dir):
    """The same join with keys counted as heavy from a few rows on."""
    tx = tx_raw(spark, sf_dir)
    joined = joined_transactions(tx, crm_raw(spark, sf_dir), latest_first=newest_first(),
                                 heavy=heavy_keys(tx, "customer_id", min_rows=12))
    return joined.drop("etl_timestamp")


def normalised_names(spark, sf_dir):
    """Column names as an export might have them, brought into one form."""
    orders = table(spark, sf_dir, "orders")
    return normalise_names(orders.select(F.col("o_orderkey").alias("Order Key"), F.col("o_custkey").alias("CUST-Key"),
                                         F.col("o_totalprice").alias("Total Price")))


def cast_defaults(spark, sf_dir):
    return tx_raw(spark, sf_dir).select(
        "transaction_id", "ingest_seq", c.cast_or(F.col("amount"), "double", -1.0).alias("amount_or_default"),
        c.cast_or(F.col("customer_id"), "bigint", 0).alias("customer_or_default"))


def run_dates(spark, sf_dir):
    orders, day = table(spark, sf_dir, "orders"), F.col("o_orderdate").cast("date")
    return orders.select("o_orderkey", c.days_before(day).alias("yesterday"),
                         c.days_before(day, 30).alias("month_before"),
                         F.date_format("o_orderdate", c.ISO_SECONDS).alias("iso_text"))


def json_landing(spark, sf_dir):
    """CRM records landed as JSON, read back with a schema, cleaned, landed under their day (twice, as after a retry)."""
    records, landed = run_dir(spark, "crm-json"), run_dir(spark, "crm-landed")
    crm_raw(spark, sf_dir).drop("ingest_seq").write.json(records)
    read = standardise_customers(json_records(spark, records, RAW_CUSTOMER))
    for _ in range(2):
        land_extract(read, landed, RUN_DAY)
    return spark.read.parquet(landed)


def batch_joined_stamped(spark, sf_dir):
    """The load time of every joined row, here a fixed one."""
    joined = joined_transactions(tx_raw(spark, sf_dir), crm_raw(spark, sf_dir), latest_first=newest_first(), run_ts=RUN_TS)
    return joined.select("transaction_id", "customer_id", F.col("etl_timestamp").cast("timestamp_ntz").alias("etl_timestamp"))


def zone_texts(spark, sf_dir):
    """The same instant as text in two zones."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", c.iso_text(F.col("o_orderdate")).alias("utc"), c.iso_text(F.col("o_orderdate"), "Asia/Tokyo").alias("tokyo"))


def _load_joined(spark, sf_dir, monthly):
    path = run_dir(spark, "joined")
    run_batch(tx_raw(spark, sf_dir), crm_raw(spark, sf_dir), path, latest_first=newest_first(), monthly=monthly, run_ts=RUN_TS)
    return spark.read.parquet(path).drop("etl_timestamp")


def partitioned_load(spark, sf_dir):
    """All rows of the joined table, stored by month and read back."""
    return _load_joined(spark, sf_dir, True)


def partitioned_load_daily(spark, sf_dir):
    """The same in a folder per day."""
    return _load_joined(spark, sf_dir, False)


def warehouse_load(spark, sf_dir):
    """The batch load replaces a table, whatever the case of the target's name; the router then appends to it."""
    root = run_dir(spark, "warehouse")
    targets = {"files": warehouse.files(root)}
    rows = standardise_transactions(tx_raw(spark, sf_dir))
    for _ in range(2):
        warehouse.load(rows, "transactions_fact", targets, "FILES", expected=rows.schema)
    warehouse.sink(rows.where("is_valid"), "transactions_fact", targets, "files")
    return spark.read.parquet(f"{root}/transactions_fact").withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


def _outcome(action):
    """Rows written, or what stopped the load."""
    try:
        return action(), "ok"
    except (TooManyBadRecords, warehouse.SchemaMismatch, AnalysisException, ValueError) as error:
        return None, {"TooManyBadRecords": "too many bad records", "SchemaMismatch": "schema"}.get(type(error).__name__, "refused")


def load_outcomes(spark, sf_dir):
    """Row counts given by every way to save, dispositions, the schema check and the bad-record limit."""
    root, tx = run_dir(spark, "outcomes"), tx_raw(spark, sf_dir)
    targets = {"files": warehouse.files(root)}
    rows, bad = standardise_transactions(tx), standardise_transactions(tx).where("not is_valid")
    wider = StructType([*rows.schema.fields, StructField("channel", StringType())])
    steps = [
        ("run_batch", lambda: run_batch(tx, crm_raw(spark, sf_dir), f"{root}/joined", latest_first=newest_first(), monthly=True)),
        ("load", lambda: warehouse.load(rows, "t", targets, "FILES", prefix="dw_")),
        ("sink", lambda: warehouse.sink(bad, "t", targets, "files", prefix="dw_")),
        ("write_empty", lambda: warehouse.load(rows, "t", targets, "files", prefix="dw_", write="WRITE_EMPTY")),
        ("create_never", lambda: warehouse.load(rows, "u", targets, "files", create="CREATE_NEVER", table_exists=False)),
        ("unknown_target", lambda: warehouse.sink(rows, "t", targets, "FILES")),
        ("schema", lambda: warehouse.load(rows, "t", targets, "files", prefix="dw_", expected=wider)),
        ("limit_5", lambda: check_bad_records(bad, 5)),
        ("limit_all", lambda: check_bad_records(bad, 1 << 30)),
        ("in_table", lambda: spark.read.parquet(f"{root}/dw_t").count()),
    ]
    return spark.createDataFrame([(name, *_outcome(step)) for name, step in steps], "step string, rows bigint, outcome string")


def written_audit(spark, sf_dir):
    """The load log after a load, an append and a load that fails, pruned to the last month."""
    root, log = run_dir(spark, "audited"), run_dir(spark, "audit")
    rows, target = standardise_transactions(tx_raw(spark, sf_dir)), warehouse.files(root)
    old = (None, "old", 1, *[datetime(2000, 1, 1, tzinfo=timezone.utc)] * 2, "ok")
    spark.createDataFrame([old], LOAD_AUDIT).write.parquet(log)
    audited_save(rows, "t", target, log, "overwrite")
    audited_save(rows.where("is_valid"), "t", target, log)
    try:
        audited_save(rows, "t", target, log, "error")
    except AnalysisException:
        pass
    prune_audit(spark, log, F.current_timestamp())
    return read_audit(spark, log).select(
        "table", "rows", "status", (F.col("finished") >= F.col("started")).alias("in_order"),
        (F.length("load_id") == 32).alias("has_id"))


def file_sizes(spark, sf_dir):
    """Files written with a limit of rows per file: all rows are there and no file has more."""
    root = run_dir(spark, "sized")
    warehouse.save(table(spark, sf_dir, "orders"), "orders", warehouse.files(root, max_records_per_file=500), "overwrite")
    per_file = spark.read.parquet(f"{root}/orders").groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    return per_file.agg(F.sum("n").alias("rows"), (F.max("n") <= 500).alias("within_limit"))


def source_by_spec(spark, sf_dir):
    """The same table opened by two specifications, one of them of landed JSON files."""
    landed = run_dir(spark, "nation-json")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").write.json(f"{landed}/a/b")
    by_json = read_source(spark, {"type": "json", "path": landed, "extension": ".json", "recursive": True},
                          "o_orderkey bigint, o_custkey bigint, o_orderstatus string")
    by_parquet = read_source(spark, {"type": "parquet", "path": f"{sf_dir}/orders.parquet"})
    return by_json.withColumn("format", F.lit("json")).unionByName(
        by_parquet.select(*by_json.columns, F.lit("parquet").alias("format")))


QUERIES = {
    "batch_joined": batch_joined,
    "batch_joined_split": batch_joined_split,
    "crm_clean": lambda spark, sf_dir: clean_customers(crm_raw(spark, sf_dir), newest_first()),
    "tx_clean": lambda spark, sf_dir: clean_transactions(tx_raw(spark, sf_dir), newest_first()),
    "tx_clean_drop_null_ids": lambda spark, sf_dir: clean_transactions(tx_raw(spark, sf_dir), newest_first(), "drop"),
    "tx_clean_keep_null_ids": lambda spark, sf_dir: clean_transactions(tx_raw(spark, sf_dir), newest_first(), "keep"),
    "daily_extract": lambda spark, sf_dir: day_before(table(spark, sf_dir, "orders"), "o_orderdate", RUN_DAY),
    "duplicates_by_key": lambda spark, sf_dir: duplicate_keys(tx_raw(spark, sf_dir), "transaction_id"),
    "normalised_names": normalised_names,
    "cast_defaults": cast_defaults,
    "run_dates": run_dates,
    "masked_customers": lambda spark, sf_dir: mask_customers(clean_customers(crm_raw(spark, sf_dir), newest_first())),
    "json_landing": json_landing,
    "partitioned_load": partitioned_load,
    "partitioned_load_daily": partitioned_load_daily,
    "warehouse_load": warehouse_load,
    "batch_joined_stamped": batch_joined_stamped,
    "zone_texts": zone_texts,
    "load_outcomes": load_outcomes,
    "load_audit_written": written_audit,
    "file_sizes": file_sizes,
    "source_by_spec": source_by_spec,
}

_JOINED = f"""WITH {CRM_CTES}, {TX_CTES},
joined AS (
  SELECT t.*, c.first_name, c.last_name, c.email, c.phone, c.country, c.status AS crm_status, c.age,
    c.ingest_seq AS crm_ingest_seq, c.is_active, c.full_name
  FROM tx_clean t LEFT JOIN crm_clean c ON t.customer_id = c.customer_id)"""

ORACLES = {
    "batch_joined": f"{_JOINED} SELECT * FROM joined",
    "batch_joined_split": f"{_JOINED} SELECT * FROM joined",
    "crm_clean": f"WITH {CRM_CTES} SELECT * FROM crm_clean",
    "tx_clean": f"WITH {TX_CTES} SELECT * FROM tx_clean",
    "tx_clean_drop_null_ids": f"WITH {TX_CTES} SELECT * FROM tx_clean WHERE transaction_id IS NOT NULL",
    "tx_clean_keep_null_ids": f"""WITH {TX_CTES} SELECT * FROM tx_clean WHERE transaction_id IS NOT NULL
        UNION ALL SELECT * FROM tx_std WHERE transaction_id IS NULL""",
    "daily_extract": "SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-09-01'",
    "duplicates_by_key": f"""WITH {TX_CTES} SELECT transaction_id, count(*) AS occurrences FROM tx_raw
        WHERE transaction_id IS NOT NULL GROUP BY transaction_id HAVING count(*) > 1""",
    "normalised_names": "SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_totalprice AS total_price FROM orders",
    "cast_defaults": f"""WITH {TX_CTES} SELECT transaction_id, ingest_seq,
        coalesce(TRY_CAST(amount AS DOUBLE), -1.0) AS amount_or_default,
        coalesce(TRY_CAST(customer_id AS BIGINT), 0) AS customer_or_default FROM tx_raw""",
    "run_dates": """SELECT o_orderkey, CAST(o_orderdate AS DATE) - 1 AS yesterday,
        CAST(o_orderdate AS DATE) - 30 AS month_before, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso_text FROM orders""",
    "masked_customers": f"""WITH {CRM_CTES} SELECT * REPLACE (
        regexp_replace(regexp_replace(regexp_replace(phone, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')
          AS phone, sha256(email) AS email) FROM crm_clean""",
    "json_landing": f"""WITH {CRM_CTES} SELECT * EXCLUDE (ingest_seq), DATE '1998-09-02' AS extraction_date FROM crm_std""",
    "warehouse_load": f"""WITH {TX_CTES} SELECT * FROM tx_std UNION ALL SELECT * FROM tx_std WHERE is_valid""",
    "partitioned_load": f"""{_JOINED} SELECT *, CAST(date_trunc('month', transaction_date) AS DATE) AS transaction_month FROM joined""",
    "partitioned_load_daily": _JOINED + " SELECT * FROM joined",
    "batch_joined_stamped": f"{_JOINED} SELECT transaction_id, customer_id, TIMESTAMP '2001-01-01 06:30:00' AS etl_timestamp FROM joined",
    "zone_texts": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS utc,
        strftime(o_orderdate + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S') AS tokyo FROM orders""",
    "load_outcomes": f"""{_JOINED}, n AS (SELECT (SELECT count(*) FROM joined) AS j, (SELECT count(*) FROM tx_std) AS t,
            (SELECT count(*) FROM tx_std WHERE NOT is_valid) AS b)
        SELECT 'run_batch' AS step, j AS rows, 'ok' AS outcome FROM n UNION ALL SELECT 'load', t, 'ok' FROM n
        UNION ALL SELECT 'sink', b, 'ok' FROM n UNION ALL SELECT 'write_empty', NULL, 'refused'
        UNION ALL SELECT 'create_never', NULL, 'refused' UNION ALL SELECT 'unknown_target', NULL, 'refused'
        UNION ALL SELECT 'schema', NULL, 'schema'
        UNION ALL SELECT 'limit_5', NULL, CASE WHEN b > 5 THEN 'too many bad records' ELSE 'ok' END FROM n
        UNION ALL SELECT 'limit_all', NULL, 'ok' UNION ALL SELECT 'in_table', t + b, 'ok' FROM n""",
    "load_audit_written": f"""WITH {TX_CTES} SELECT 't' AS "table", count(*) AS rows, 'ok' AS status, true AS in_order,
            true AS has_id FROM tx_std
        UNION ALL SELECT 't', count(*), 'ok', true, true FROM tx_std WHERE is_valid
        UNION ALL SELECT 't', NULL, 'error', true, true""",
    "file_sizes": "SELECT count(*) AS rows, true AS within_limit FROM orders",
    "source_by_spec": """SELECT o_orderkey, o_custkey, o_orderstatus, unnest(['json', 'parquet']) AS format FROM orders""",
}
