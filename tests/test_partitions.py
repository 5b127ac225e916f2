"""Symbol buckets, the swap of partitions, and the plan of an upsert."""

import pytest
from pyspark.sql import functions as F

from barlake.operators import append_bars, create_bar_table, merge_into, month_exists, month_range
from barlake.operators import partitions, upsert
from barlake.operators.table import bucket_of, symbol_buckets, table_location
from barlake.plans import load_raw
from barlake.schema import BAR_COLUMNS
from barlake.functions import to_bars
from conftest import bars, raw_frame

KEYS = ["symbol", "event_time"]
SYMBOLS = ["A", "B", "C", "D", "E", None]


def frame(spark, rows):
    return to_bars(raw_frame(spark, [(s, "2023", "01", t, c) for s, t, c in rows])).drop("year", "month")


@pytest.fixture
def bucketed(spark, tmp_path):
    table = "bars_test.bucketed_" + tmp_path.name.replace("-", "_")
    create_bar_table(spark, table, str(tmp_path / "bucketed"), with_symbol=True, symbol_buckets=3)
    return table


def files(spark, table):
    return set(spark.table(table).inputFiles())


def test_a_load_leaves_files_of_other_buckets_alone(spark, bucketed):
    rows = [(s, f"2023-0{m}-01 00:00", float(m)) for s in "ABCDE" for m in (1, 2)]
    append_bars(spark, bucketed, frame(spark, rows))
    before = files(spark, bucketed)
    assert len(before) == 2 * len({r[0] for r in spark.table(bucketed).select("symbol_bucket").collect()})
    done = merge_into(spark, bucketed, frame(spark, [("A", "2023-01-01 00:00", 9.0), ("A", "2023-01-02 00:00", 8.0)]), KEYS)
    assert (done.updated, done.inserted) == (1, 1)
    after = files(spark, bucketed)
    assert len(before - after) == len(after - before) == 1 and "event_month=2023-01-01" in (before - after).pop()
    closes = {(r["symbol"], str(r["event_time"])[:10]): r["close"] for r in spark.table(bucketed).collect()}
    assert closes.pop(("A", "2023-01-01")) == 9.0 and closes.pop(("A", "2023-01-02")) == 8.0
    assert set(closes.values()) == {1.0, 2.0} and len(closes) == 9


def test_both_partition_columns_prune(spark, bucketed):
    append_bars(spark, bucketed, frame(spark, [(s, "2023-01-01 00:00", 1.0) for s in "ABCDE"]))
    assert symbol_buckets(spark, bucketed) == 3
    rows = month_range(spark.table(bucketed), 2023, 1, "A", buckets=3)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].splitlines()[0]
    assert "event_month" in filters and "symbol_bucket" in filters
    assert len(rows.inputFiles()) == 1 and rows.count() == 1
    assert month_exists(spark, bucketed, 2023, 1, "A") and not month_exists(spark, bucketed, 2023, 1, "X")


def test_pairs_of_month_and_bucket_prune(spark, bucketed):
    append_bars(spark, bucketed, frame(spark, [(s, f"2023-0{m}-01 00:00", 1.0) for s in "ABCDE" for m in (1, 2)]))
    wanted = sorted(partitions.listed_partitions(spark, bucketed))[::3]
    kept = spark.table(bucketed).filter(partitions.in_partitions(wanted, ["event_month", "symbol_bucket"]))
    found = {tuple(r) for r in kept.select("event_month", "symbol_bucket").distinct().collect()}
    assert found == set(wanted) and len(kept.inputFiles()) == len(wanted)


def test_buckets_need_the_symbol(spark, bucketed, tmp_path):
    with pytest.raises(ValueError, match="symbol"):
        merge_into(spark, bucketed, frame(spark, [("A", "2023-01-01 00:00", 1.0)]))
    with pytest.raises(ValueError, match="symbols"):
        create_bar_table(spark, "bars_test.none", str(tmp_path / "none"), symbol_buckets=3)


def test_buckets_are_known_numbers(spark):
    import zlib

    rows = spark.createDataFrame([(s,) for s in SYMBOLS], "symbol string")
    got = {r[0]: r[1] for r in rows.select("symbol", bucket_of(F.col("symbol"), 7)).collect()}
    assert got == {s: zlib.crc32((s or "").encode()) % 7 for s in SYMBOLS}


def test_upserts_into_buckets_equal_those_into_months(spark, bucketed, make_table):
    plain = make_table(with_symbol=True)
    first = [(s, f"2023-0{m}-0{d} 00:00", float(10 * m + d)) for s in "ABCDE" for m in (1, 2, 3) for d in (1, 2)]
    first += first[:2]  # rows that repeat in the target
    second = [(s, f"2023-0{m}-02 00:00", -1.0) for s in "ACX" for m in (2, 3, 4)] + [("A", "2023-01-01 00:00", -2.0)]
    for table in (bucketed, plain):
        append_bars(spark, table, frame(spark, first))
        merge_into(spark, table, frame(spark, second), KEYS)
        merge_into(spark, table, frame(spark, [(None, "2023-01-01 00:00", 5.0)]), KEYS, null_keys="insert")
    rows = lambda t: sorted((tuple(r) for r in spark.table(t).select("symbol", "event_time", "close").collect()), key=repr)
    assert rows(bucketed) == rows(plain)
    raw = raw_frame(spark, [("B", "2023", "02", "2023-02-02 00:00", 7.0)])
    assert load_raw(spark, bucketed, raw, KEYS).updated == 1


MONTHS = ["2023-01", "2023-02", "2023-03"]


@pytest.mark.parametrize("done", [0, 1, 2])
def test_a_driver_lost_in_the_swap_leaves_every_month_old_or_new(spark, make_table, monkeypatch, done):
    table = make_table()
    append_bars(spark, table, frame(spark, [("A", f"{m}-01 00:00", 1.0) for m in MONTHS]))
    point, seen = partitions._point, []

    def lost(*args):
        if len(seen) == done:
            raise RuntimeError("lost")
        seen.append(args)
        point(*args)

    monkeypatch.setattr(partitions, "_point", lost)
    new = frame(spark, [("A", f"{m}-{d} 00:00", 2.0) for m in MONTHS for d in ("01", "02")])
    with pytest.raises(RuntimeError):
        merge_into(spark, table, new)
    monkeypatch.undo()
    spark.catalog.refreshTable(table)
    closes = [[c for t, c in bars(spark.table(table)) if str(t).startswith(m)] for m in MONTHS]
    assert closes == [[2.0, 2.0]] * done + [[1.0]] * (3 - done)
    merge_into(spark, table, new)
    assert [c for _, c in bars(spark.table(table))] == [2.0] * 6


def test_a_failed_write_leaves_nothing(spark, make_table):
    table = make_table()
    append_bars(spark, table, frame(spark, [("A", "2023-01-01 00:00", 1.0)]))
    before = files(spark, table)
    with pytest.raises(Exception, match="several source rows"):
        merge_into(spark, table, frame(spark, [("A", "2023-01-01 00:00", 2.0)] * 2))
    assert files(spark, table) == before
    assert not partitions.matching(spark, f"{table_location(spark, table)}/_versions/*")


def test_swapped_months_are_found_without_the_catalog(spark, make_table, tmp_path):
    table = make_table()
    append_bars(spark, table, frame(spark, [("A", f"{m}-01 00:00", 1.0) for m in MONTHS]))
    merge_into(spark, table, frame(spark, [("A", "2023-02-01 00:00", 2.0), ("A", "2023-04-01 00:00", 3.0)]))
    merge_into(spark, table, frame(spark, [("A", "2023-02-02 00:00", 4.0)]))
    wanted = [1.0, 2.0, 4.0, 1.0, 3.0]
    assert [c for _, c in bars(spark.table(table))] == wanted
    create_bar_table(spark, f"{table}_again", table_location(spark, table))
    assert [c for _, c in bars(spark.table(f"{table}_again"))] == wanted
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (event_month = date'2023-02-01')")
    merge_into(spark, table, frame(spark, [("A", "2023-02-03 00:00", 5.0)]))
    assert [c for _, c in bars(spark.table(table))] == [1.0, 2.0, 4.0, 5.0, 1.0, 3.0]


def test_an_upsert_scans_the_target_once_and_shuffles_once(spark, make_table):
    table = make_table()
    append_bars(spark, table, frame(spark, [("A", "2023-01-01 00:00", 1.0)]))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        target = spark.table(table)
        rows, _ = upsert.merge_by_grouping(target, target.select("*"), ["event_time"])
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert plan.count("FileScan") == 2 and plan.count("Exchange") == 1 and "Join" not in plan
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan


def test_a_hot_target_key_reaches_no_task_whole(spark, make_table):
    """A third of the target at one time: the grouping leaves it out, the join takes it."""
    table = make_table()
    rows = [("A", "2023-01-01 00:00", float(i)) for i in range(300)]
    rows += [("A", f"2023-01-{d:02d} {h:02d}:00", 1.0) for d in range(2, 28) for h in range(24)]
    append_bars(spark, table, frame(spark, rows))
    done = merge_into(spark, table, frame(spark, [("A", "2023-01-01 00:00", -1.0), ("A", "2023-01-02 00:00", -1.0)]))
    assert (done.updated, done.inserted) == (301, 0)
    assert spark.table(table).filter("close = -1").count() == 301 and spark.table(table).count() == len(rows)
    assert BAR_COLUMNS == spark.table(table).drop("event_month").columns
