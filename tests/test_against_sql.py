"""Every query with an SQL twin, at the smallest scale, against DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
SQL = driver.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return repr(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(canonical(row[c]) for c in columns) for row in df.collect())
    result = duck.execute(SQL[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(tuple(canonical(row[i]) for i in places) for row in result.fetchall())


def test_sql_keys_are_queries():
    assert set(SQL) <= set(driver.queries())
