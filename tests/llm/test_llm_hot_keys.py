"""Joins with nine tenths of the rows on one key give that key to several tasks."""

from contextlib import contextmanager

import llm_brute as brute
import pytest
from barlake.llm import components, near_dup

SMALL = {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.maxPartitionBytes": "32k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def small_partitions(spark):
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name in SMALL:
        spark.conf.unset(name)


@contextmanager
def plans_of(monkeypatch, module):
    """Final plans of the steps that a module stores, by name."""
    store, plans = module.stored, {}

    def watched(rows, name, *parts):
        rows.collect()
        plans.setdefault(name, []).append(rows._jdf.queryExecution().executedPlan().toString())
        return store(rows, name, *parts)

    monkeypatch.setattr(module, "stored", watched)
    yield plans
    monkeypatch.undo()


def test_a_node_with_many_edges_is_split(spark, small_partitions, monkeypatch):
    rows = [(0, i) for i in range(1, 20_000)] + [(30_000 + 2 * i, 30_001 + 2 * i) for i in range(1000)]
    edges = spark.createDataFrame(rows, "a bigint, b bigint").repartition(8)
    with plans_of(monkeypatch, components) as plans:
        found = components.connected_components(edges)
        assert found.filter("root = 0").count() == 20_000 and found.filter("root > 0").count() == 2000
    assert any("SortMergeJoin(skew=true)" in p for p in plans["edges"])


def test_many_copies_are_split(spark, small_partitions, monkeypatch):
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(i, passage) for i in range(9000)] + [(9000 + i, f"{passage} x{i} y{i} z{i} v{i} u{i} t{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, brute.SCHEMA).repartition(8)
    with plans_of(monkeypatch, near_dup) as plans:
        found = near_dup.near_duplicate_groups(docs, 3, 85)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plans["nodes"][0]
    assert found.filter("component_id = 0").count() >= 9000 and "SortMergeJoin(skew=true)" in plan
