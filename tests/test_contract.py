"""Registered queries against their oracle SQL on the smallest tables."""

import datetime as dt
import math
from pathlib import Path

import pytest

import __spark_entry__ as contract
from workbench import catalogue, oracle

DATA = Path("/root/testdata/sf0.001")
#: The training-data queries have tests of their own.
NAMES = list(catalogue.queries())

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.sql(f"create view {file.stem} as select * from '{file}'")
    return connection


def _value(v):
    if isinstance(v, dt.datetime):
        return v.date()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = contract.queries()[name](spark, str(DATA))
    expected = duck.sql(contract.oracle_sql()[name])
    assert sorted(got.columns) == sorted(expected.columns)
    assert _rows(got.columns, got.collect()) == _rows(expected.columns, expected.fetchall())


def test_every_query_has_an_oracle():
    assert set(catalogue.queries()) == set(oracle.oracle_sql())
    assert set(catalogue.queries()) <= set(contract.queries())


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0
