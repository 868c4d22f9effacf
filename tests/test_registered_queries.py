"""Every registered query with SQL gives the same rows in DuckDB."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SLOW = {"rf_cls", "gbt_cls", "rf_reg", "gbt_reg", "training_summary"}
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for file in os.listdir(small):
        connection.execute(f"create view {file.removesuffix('.parquet')} as select * from '{small}/{file}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value) + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_contract_is_complete():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    expected = duck.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_runs_without_sql(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
