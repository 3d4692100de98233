"""Raw tables of the domain, derived from the given ones.

The given tables are too clean to show what cleaning and rules do, so the views
spoil some rows by key arithmetic. The same SQL text runs on both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CRM_RAW = """
WITH base AS (
  SELECT c_custkey k, c_name, c_nationkey, 1 AS ingest_seq FROM {customer}
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, 2 FROM {customer} WHERE c_custkey % 20 = 0)
SELECT CAST(k AS STRING) AS customer_id,
  CASE WHEN k % 17 = 0 THEN NULL ELSE 'First' || CAST(k AS STRING) END AS first_name,
  c_name AS last_name,
  CASE WHEN k % 23 = 0 THEN 'invalid-email' WHEN k % 29 = 0 THEN NULL
       ELSE '  User' || CAST(k AS STRING) || '@Example.COM ' END AS email,
  '+212 (' || CAST(ingest_seq AS STRING) || ') ' || CAST(100000 + k AS STRING) || '-00' AS phone,
  ' nation_' || CAST(c_nationkey AS STRING) || ' ' AS country,
  CASE WHEN k % 3 = 0 THEN 'active' WHEN k % 3 = 1 THEN 'inactive'
       WHEN k % 13 = 0 THEN NULL ELSE 'Active' END AS status,
  CAST(CASE WHEN k % 31 = 0 THEN 150 WHEN k % 37 = 0 THEN 17 ELSE 18 + k % 83 END AS BIGINT) AS age,
  ingest_seq
FROM base"""

TX_RAW = """
WITH base AS (
  SELECT o_orderkey k, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 1 AS ingest_seq FROM {orders}
  UNION ALL
  SELECT o_orderkey, o_custkey, 'O', o_totalprice, o_orderdate, 2 FROM {orders} WHERE o_orderkey % 25 = 0)
SELECT CASE WHEN k % 307 = 0 THEN NULL ELSE 'T' || CAST(k AS STRING) END AS transaction_id,
  CASE WHEN k % 50 = 1 THEN CAST(o_custkey + 10000000 AS STRING) WHEN k % 211 = 0 THEN NULL
       ELSE CAST(o_custkey AS STRING) END AS customer_id,
  CASE WHEN k % 97 = 0 THEN 'abc' WHEN k % 41 = 0 THEN '-5.0' WHEN k % 43 = 0 THEN NULL
       ELSE CAST(o_totalprice AS STRING) END AS amount,
  CASE WHEN k % 61 = 0 THEN '2025-13-01' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS transaction_date,
  CASE WHEN k % 4 = 0 THEN ' usd ' WHEN k % 4 = 1 THEN 'EUR' WHEN k % 4 = 2 THEN 'mad' ELSE 'BADX' END AS currency,
  CASE WHEN k % 71 = 0 THEN 'UNKNOWN' WHEN o_orderstatus = 'F' THEN 'FAILED'
       WHEN o_orderstatus = 'O' THEN 'SUCCESS' ELSE 'PENDING' END AS status,
  o_orderdate AS event_ts,
  ingest_seq
FROM base"""

TX_STREAM = """
SELECT 'E' || CAST(event_id AS STRING) AS transaction_id,
  CAST(user_id AS STRING) AS customer_id,
  value AS amount,
  ts AS event_ts
FROM {events}"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crm_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CRM_RAW, customer=table(spark, sf_dir, "customer"))


def tx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TX_RAW, orders=table(spark, sf_dir, "orders"))


def tx_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TX_STREAM, events=table(spark, sf_dir, "events"))


def as_cte(name: str, view: str) -> str:
    """The view as a named query for the checking SQL."""
    return f"{name} AS ({view.format(**{t: t for t in ('customer', 'orders', 'events')})})"


# The same cleaning, in SQL.
CRM_CTES = as_cte("crm_raw", CRM_RAW) + """,
crm_std AS (
  SELECT customer_id, first_name, last_name, lower(trim(email, ' ')) AS email,
    regexp_replace(phone, '[^0-9]', '', 'g') AS phone, upper(trim(country, ' ')) AS country, status, age, ingest_seq,
    CASE WHEN status = 'active' THEN 1 ELSE 0 END AS is_active, concat_ws(' ', first_name, last_name) AS full_name
  FROM crm_raw),
crm_clean AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ingest_seq DESC NULLS LAST, first_name NULLS FIRST,
      last_name NULLS FIRST, email NULLS FIRST, phone NULLS FIRST, country NULLS FIRST, status NULLS FIRST,
      age NULLS FIRST, is_active, full_name) AS rn
    FROM crm_std) WHERE rn = 1)"""

TX_CTES = as_cte("tx_raw", TX_RAW) + """,
tx_std AS (
  SELECT transaction_id, customer_id, TRY_CAST(amount AS DOUBLE) AS amount,
    CAST(try_strptime(transaction_date, '%Y-%m-%d') AS DATE) AS transaction_date, upper(trim(currency, ' ')) AS currency,
    status, event_ts, ingest_seq, coalesce(TRY_CAST(amount AS DOUBLE) > 0, false) AS is_valid
  FROM tx_raw),
tx_clean AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY ingest_seq DESC NULLS LAST,
      customer_id NULLS FIRST, amount NULLS FIRST, transaction_date NULLS FIRST, currency NULLS FIRST,
      status NULLS FIRST, event_ts NULLS FIRST, is_valid) AS rn
    FROM tx_std) WHERE rn = 1)"""

STREAM_CTE = as_cte("tx_stream", TX_STREAM)
