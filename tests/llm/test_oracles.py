"""Registered operators against their DuckDB text."""

from pathlib import Path

import duckdb
import pytest

from wardspark.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_operator_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in df.columns]
    expected = sorted(repr(tuple(row[i] for i in order)) for row in cursor.fetchall())
    assert sorted(repr(tuple(row)) for row in df.collect()) == expected
