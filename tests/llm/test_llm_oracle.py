"""The registered queries against their SQL, on whole tables."""

import os
from collections import Counter

import duckdb
import pytest

from tallyfold.llm import queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def rows_of(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    got = df.collect()
    result = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    want, have = rows_of(result.fetchall(), columns), rows_of(got, df.columns)
    assert have == want, f"only Spark: {list((have - want).items())[:3]}, only SQL: {list((want - have).items())[:3]}"
