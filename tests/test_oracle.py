"""Every query with an oracle gives the same rows as its SQL on the small tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import TESTDATA

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="no test data")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in TESTDATA.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return round(float(value), 9)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([normal(r[i]) for i in order] for r in rows), key=lambda r: [str(v) for v in r])


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_its_oracle(spark, oracle, name):
    result = entry.queries()[name](spark, str(TESTDATA))
    expected = oracle.sql(entry.oracle_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    assert table(result.columns, result.collect()) == table(expected.columns, expected.fetchall())


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 150
