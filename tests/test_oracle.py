"""Each query against its SQL on the same tables: same columns, same rows, same values."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import DATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    # A whole number is not the same result as a fraction that happens to be whole.
    return (type(value).__name__, value) if isinstance(value, int | float) else value


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(row[i]) for i in order) for row in rows], key=repr)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    result = contract.queries()[name](spark, str(DATA))
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(result.columns) == sorted(names)
    got = normal(result.columns, [tuple(r) for r in result.collect()])
    want = normal(names, cursor.fetchall())
    assert got
    assert len(got) == len(want)
    different = [(g, w) for g, w in zip(got, want) if g != w]
    assert not different, (len(different), different[:3])


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_rows_only(spark, name):
    result = contract.queries()[name](spark, str(DATA))
    assert result.count() > 0


def test_entry(spark):
    assert contract.entry(spark).columns == contract.queries()["hourly_avg"](spark, str(DATA)).columns
