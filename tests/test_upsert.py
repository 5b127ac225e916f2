import pathlib
import random

import pytest
from pyspark.sql import functions as F

from barlake.functions import to_bars
from barlake.operators import append_bars, merge, merge_actions, merge_into
from barlake.schema import BAR_COLUMNS
from conftest import at, bars, ms, raw_frame

ERROR = "several source rows match one target row"


def frame(spark, rows, symbol="A"):
    """Bars from (time, close) or (symbol, time, close)."""
    full = [(symbol, *r) if len(r) == 2 else r for r in rows]
    return to_bars(raw_frame(spark, [(s, "2023", "01", t, c) for s, t, c in full])).drop("year", "month")


def model(target, source):
    """What a MERGE on time leaves of (time, close) lists, row by row."""
    result, new = [], []
    for time, close in target:
        hits = [c for t, c in source if t is not None and t == time]
        if len(hits) > 1:
            raise ValueError(ERROR)
        result.append((time, hits[0] if hits else close))
    known = {t for t, _ in target if t is not None}
    new = [(t, c) for t, c in source if t not in known]
    return sorted(result + new, key=lambda p: (p[0] is not None, p))


def as_times(pairs):
    return [(None if t is None else at("1970-01-01") + (at("1970-01-01 00:00:00.001") - at("1970-01-01")) * t, c) for t, c in pairs]


def random_rows(rng, n, spread, nulls=0.0):
    minute = 60_000 * 60 * 24
    start = ms("2022-12-20")
    return [
        (None if rng.random() < nulls else start + rng.randrange(spread) * minute, float(rng.randrange(1000)))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(6))
def test_merge_agrees_with_a_row_by_row_model(spark, seed):
    rng = random.Random(seed)
    target = random_rows(rng, 40, 60, nulls=0.1)
    source = list(dict(random_rows(rng, 25, 90)).items()) + [(None, -1.0), (None, -2.0)]
    unmatched_twice = ms("2024-01-01")
    source += [(unmatched_twice, 1.0), (unmatched_twice, 2.0)]
    got = merge(frame(spark, target).select(*BAR_COLUMNS), frame(spark, source))
    assert bars(got) == as_times(model(target, source))


@pytest.mark.parametrize("action", ["collect", "count"])
def test_two_source_rows_for_one_target_row(spark, action):
    target = frame(spark, [("2023-01-01 00:00", 1.0)]).select(*BAR_COLUMNS)
    source = frame(spark, [("2023-01-01 00:00", 2.0), ("2023-01-01 00:00", 3.0)])
    with pytest.raises(Exception, match=ERROR):
        getattr(merge(target, source), action)()


def test_actions(spark):
    target = frame(spark, [("2023-01-01 00:00", 1.0), ("2023-01-02 00:00", 2.0)]).select(*BAR_COLUMNS)
    source = frame(spark, [("2023-01-02 00:00", 5.0), ("2023-02-03 00:00", 6.0)])
    rows = merge_actions(target, source).select("close", "merge_action").collect()
    assert {tuple(r) for r in rows} == {(1.0, "kept"), (5.0, "updated"), (6.0, "inserted")}


def test_hot_source_key_is_reduced_before_the_shuffle(spark):
    target = frame(spark, [("2023-01-01 00:00", 1.0)]).select(*BAR_COLUMNS)
    plan = merge(target, frame(spark, [("2023-02-01 00:00", 1.0)]))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan and "HashAggregate" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("seed", range(3))
def test_merge_into_and_again(spark, make_table, seed):
    rng = random.Random(100 + seed)
    table = make_table()
    target, source = random_rows(rng, 60, 80), list(dict(random_rows(rng, 40, 120)).items())
    append_bars(spark, table, frame(spark, target))
    expected = model(target, source)
    done = merge_into(spark, table, frame(spark, source))
    assert bars(spark.table(table)) == as_times(expected)
    times = {t for t, _ in source}
    updated = sum(t in times for t, _ in target)
    inserted = len(expected) - len(target)
    assert (done.source, done.updated, done.inserted, done.rejected) == (len(source), updated, inserted, 0)

    again = merge_into(spark, table, frame(spark, source))
    assert bars(spark.table(table)) == as_times(model(expected, source))
    assert again.inserted == 0


def test_into_an_empty_table_and_from_an_empty_source(spark, make_table):
    table = make_table()
    source = frame(spark, [("2023-01-01 00:00", 1.0), ("2023-02-01 00:00", 2.0)])
    done = merge_into(spark, table, source)
    assert (done.updated, done.inserted) == (0, 2) and len(bars(spark.table(table))) == 2
    nothing = merge_into(spark, table, source.limit(0))
    assert (nothing.source, nothing.updated, nothing.inserted) == (0, 0, 0)
    assert len(bars(spark.table(table))) == 2


def test_files_of_other_months_are_left_alone(spark, make_table):
    table = make_table()
    append_bars(spark, table, frame(spark, [("2023-01-01 00:00", 1.0), ("2023-02-01 00:00", 2.0)]))
    january = lambda: set(spark.table(table).filter("event_month = date'2023-01-01'").inputFiles())
    before = january()
    merge_into(spark, table, frame(spark, [("2023-02-01 00:00", 5.0)]))
    assert january() == before
    assert bars(spark.table(table)) == [(at("2023-01-01"), 1.0), (at("2023-02-01"), 5.0)]


def test_rows_without_a_key(spark, make_table):
    table = make_table()
    source = frame(spark, [(None, 7.0), ("2023-01-01 00:00", 1.0)])
    done = merge_into(spark, table, source)
    assert (done.source, done.inserted, done.rejected) == (2, 1, 1)
    assert [r["close"] for r in done.rejects.collect()] == [7.0]
    only_rejects = merge_into(spark, table, frame(spark, [(None, 7.0)]))
    assert (only_rejects.inserted, only_rejects.rejected) == (0, 1)
    assert bars(spark.table(table)) == [(at("2023-01-01"), 1.0)]


def test_rows_without_a_key_inserted_on_every_call(spark, make_table):
    table = make_table()
    source = frame(spark, [(None, 7.0), ("2023-01-01 00:00", 1.0)])
    for _ in range(2):
        merge_into(spark, table, source, null_keys="insert")
    assert bars(spark.table(table)) == [(None, 7.0), (None, 7.0), (at("2023-01-01"), 1.0)]
    with pytest.raises(ValueError):
        merge_into(spark, table, source, null_keys="drop")


def test_repeated_source_keys(spark, make_table):
    """Both are inserted while nothing matches; the second load is an error and changes nothing."""
    table = make_table()
    source = frame(spark, [("2023-01-01 00:00", 1.0), ("2023-01-01 00:00", 2.0)])
    merge_into(spark, table, source)
    with pytest.raises(Exception, match=ERROR):
        merge_into(spark, table, source)
    assert [c for _, c in bars(spark.table(table))] == [1.0, 2.0]


def test_symbols_share_a_time_only_with_the_symbol_in_the_key(spark, make_table):
    first, second = [("A", "2023-01-01 00:00", 1.0)], [("B", "2023-01-01 00:00", 2.0)]
    by_time, by_both = make_table(), make_table(with_symbol=True)
    for rows in (first, second):
        merge_into(spark, by_time, frame(spark, rows))
        merge_into(spark, by_both, frame(spark, rows), ["symbol", "event_time"])
    assert [c for _, c in bars(spark.table(by_time))] == [2.0]
    assert [c for _, c in bars(spark.table(by_both))] == [1.0, 2.0]


def test_month_on_disk_but_not_in_the_catalog_is_not_overwritten(spark, make_table):
    table = make_table()
    append_bars(spark, table, frame(spark, [("2023-01-01 00:00", 1.0)]))
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (event_month = date'2023-01-01')")  # external: files stay
    assert bars(spark.table(table)) == []
    merge_into(spark, table, frame(spark, [("2023-01-02 00:00", 2.0)]))
    assert [c for _, c in bars(spark.table(table))] == [1.0, 2.0]


def test_session_zone_does_not_matter(new_york, make_table):
    table = make_table()
    merge_into(new_york, table, frame(new_york, [("2023-01-01 00:30", 1.0)]))
    assert [str(r[0]) for r in new_york.table(table).select("event_month").collect()] == ["2023-01-01"]


@pytest.mark.parametrize("keys", [["event_time"], ["symbol", "event_time"]])
@pytest.mark.parametrize("seed", range(3))
def test_units_together_equal_units_in_turn(spark, make_table, keys, seed):
    """Units with rows outside their month, so that they meet each other's rows."""
    rng = random.Random(seed)
    target = [("A", t, c) for t, c in random_rows(rng, 15, 60)]
    units = []
    for month in ("01", "02", "03"):
        for symbol in ("A", "B"):
            label = f"2023-{month} {symbol}"
            rows = list(dict(random_rows(rng, 12, 60)).items())
            if month == "01" and symbol == "A":
                rows += rows[:2] if keys == ["symbol", "event_time"] else []
            units.append((label, [(symbol, t, c) for t, c in rows]))
    if keys == ["symbol", "event_time"]:
        target = [("C", t, c) for _, t, c in target]
    together, in_turn = make_table(with_symbol=True), make_table(with_symbol=True)
    for table in (together, in_turn):
        append_bars(spark, table, frame(spark, target))
    labelled = None
    for label, rows in units:
        part = frame(spark, rows)
        merge_into(spark, in_turn, part, keys)
        part = part.withColumn("label", F.lit(label))
        labelled = part if labelled is None else labelled.unionByName(part)
    merge_into(spark, together, labelled, keys, unit="label")
    rows = lambda table: sorted(tuple(r) for r in spark.table(table).select("symbol", "event_time", "close").collect())
    assert rows(together) == rows(in_turn)


def test_later_unit_that_repeats_a_key(spark, make_table):
    table = make_table(with_symbol=True)
    source = frame(spark, [("2023-01-01 00:00", 1.0)]).withColumn("label", F.lit("2023-01 A")).unionByName(
        frame(spark, [("2023-01-01 00:00", 2.0)] * 2).withColumn("label", F.lit("2023-02 A"))
    )
    with pytest.raises(Exception, match=ERROR):
        merge_into(spark, table, source, ["symbol", "event_time"], unit="label")
    assert spark.table(table).count() == 0


def test_first_load_has_no_join(spark, make_table, monkeypatch):
    from barlake.operators import upsert

    monkeypatch.setattr(upsert, "_apply", lambda *_: pytest.fail("joined"))
    merge_into(spark, make_table(), frame(spark, [("2023-01-01 00:00", 1.0)]))


def test_rows_added_by_another_session_survive(spark, make_table):
    table = make_table()
    append_bars(spark, table, frame(spark, [("2023-01-01 00:00", 1.0)]))
    assert spark.table(table).count() == 1
    other = spark.newSession()
    append_bars(other, table, frame(other, [("2023-01-02 00:00", 2.0)]))
    merge_into(spark, table, frame(spark, [("2023-01-03 00:00", 3.0)]))
    assert [c for _, c in bars(spark.table(table))] == [1.0, 2.0, 3.0]


def test_hot_target_key_is_split(spark, tmp_path):
    """A third of the target at one time: the join gives its rows to several tasks."""
    from barlake.operators import upsert

    n = 60_000
    time = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")) * 60_000 + ms("2023-01-01")
    raw = spark.range(0, n, 1, 8).withColumn("open_time_ms", time)
    target = to_bars(raw.withColumns({c: F.xxhash64("id", F.lit(c)).cast("double") for c in BAR_COLUMNS[:-1]}))
    once = target.dropDuplicates(["event_time"]).select(*BAR_COLUMNS)
    source, stored = (str(tmp_path / name) for name in ("source", "target"))
    once.withColumn("close", F.lit(-1.0)).write.parquet(source)
    target.select(*BAR_COLUMNS).repartition(8).write.parquet(stored)
    source, stored = spark.read.parquet(source), spark.read.parquet(stored)
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        merged = upsert._apply(stored, source, upsert._already_by_key(source, ["event_time"]), ["event_time"])
        assert merged.filter("close = -1").count() == n
        merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_stored_copies_are_dropped(spark, make_table):
    table = make_table()
    source = frame(spark, [("2023-01-01 00:00", 1.0), (None, 2.0)])
    done = merge_into(spark, table, source)
    repeated = frame(spark, [("2023-01-01 00:00", 1.0), ("2023-01-01 00:00", 2.0)])
    with pytest.raises(Exception, match=ERROR):
        merge_into(spark, table, repeated)
    assert spark.sql("SHOW NAMESPACES LIKE 'barlake_stage_*'").isEmpty()
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir")) / "barlake"
    assert not [p for p in shared.glob("barlake_stage_*") if list(p.rglob("*.parquet"))]
    assert [r["close"] for r in done.rejects.collect()] == [2.0]
