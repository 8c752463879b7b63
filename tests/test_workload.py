"""Every registered query against its SQL form in DuckDB, on the smallest data."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from ledgerlens.workload import catalog
from tests.conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"
QUERIES = {name: spark_entry.queries()[name] for name in catalog.QUERIES}
SQL = {name: sql for name, sql in spark_entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{name}'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(normal(row[i]) for i in order) for row in data]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = table(df.columns, df.collect())
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == table(columns, result.fetchall())


@pytest.mark.parametrize(
    "name, by",
    [
        ("sort_desc", ["interestexpense"]),
        ("sort_multi", ["symbol", "period", "date"]),
        ("sort_expr", ["mktcap"]),
    ],
)
def test_rows_come_in_order(spark, duck, name, by):
    """The sort keys, row after row, are those of the SQL; NULLs are among them in the first."""
    got = [tuple(r[c] for c in by) for r in QUERIES[name](spark, SF_DIR).collect()]
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert got == [tuple(row[columns.index(c)] for c in by) for row in result.fetchall()]
    assert name != "sort_desc" or (None,) in got


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
