"""Registered queries against their SQL on the smallest tables."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from barlake.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_one_query_for_each_operator():
    names = sorted(queries.queries(), key=lambda n: int(n[2:].split("_")[0]))
    assert [re.match(r"op(\d+)_", n)[1] for n in names] == [str(n) for n in range(1, 14)]
    assert {*names, "pipeline"} <= entry.queries().keys() and queries.oracle_sql().keys() <= set(names)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, oracle, name):
    got = queries.queries()[name](spark, SF_DIR)
    want = oracle.sql(queries.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = sorted(map(repr, want.project(quoted).fetchall()))
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == expected


@pytest.mark.parametrize("name", sorted(queries.queries().keys() - queries.oracle_sql().keys()))
def test_all_documents_are_in_the_result(spark, oracle, name):
    found = {r[0] for r in queries.queries()[name](spark, SF_DIR).select("doc_id").collect()}
    assert found == {r[0] for r in oracle.sql("SELECT doc_id FROM documents").fetchall()}
