"""Every registered query about bars against its SQL on the smallest tables."""

import re

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW orders AS SELECT * FROM '{SF_DIR}/orders.parquet'")
    return connection


def about_bars(names):
    return sorted(x for x in names if x != "pipeline" and not re.match(r"op\d+_", x))


def test_same_names():
    assert about_bars(entry.queries()) == about_bars(entry.oracle_sql())


@pytest.mark.parametrize("name", about_bars(entry.queries()))
def test_query(spark, oracle, name):
    got = entry.queries()[name](spark, SF_DIR)
    want = oracle.sql(entry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = sorted(map(repr, want.project(quoted).fetchall()))
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == expected


def test_flagship(spark):
    assert entry.entry(spark).count() > 1500
