"""Every registered query against its DuckDB text on the smallest tables."""

import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from wardspark.catalog import load

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return round(float(value), 9)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return bytes(value) if isinstance(value, bytearray) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in df.columns]
    expected = sorted(repr([plain(row[i]) for i in order]) for row in cursor.fetchall())
    assert sorted(repr([plain(v) for v in row]) for row in df.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_contract(spark):
    assert set(ORACLES) <= set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() == 1
