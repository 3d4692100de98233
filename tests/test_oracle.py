"""Every registered query against its SQL, value by value."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


# The optional training-data queries have the same test of their own.
OWN = [name for name in contract.queries() if contract.llm is None or name not in {*contract.llm.QUERIES, "pipeline"}]


def comparable(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(comparable(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    got = df.collect()
    assert got
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    want, have = rows_of(result.fetchall(), columns), rows_of(got, df.columns)
    assert have == want, f"only Spark: {list((have - want).items())[:3]}, only SQL: {list((want - have).items())[:3]}"


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
