import datetime as dt

import pytest

from barlake.operators import land_raw
from barlake.plans import (
    MissingRawFile,
    append_if_missing,
    backfill_plan,
    backfill_run,
    load_month,
    load_raw,
    load_units,
    missing_months,
    not_landed,
)
from barlake.sources import scan_named_files
from conftest import at, bars, csv_line, raw_frame, write_zip


def units_of(df):
    return sorted(tuple(r) for r in df.select("symbol", "year", "month").collect())


def test_plan(spark):
    symbols = spark.createDataFrame([("A",), ("B",), ("A",)], "symbol string")
    plan = backfill_plan(symbols, dt.date(2023, 11, 15), dt.date(2024, 2, 1))
    months = [("2023", "11"), ("2023", "12"), ("2024", "01"), ("2024", "02")]
    assert units_of(plan) == [(s, *m) for s in "AB" for m in months]
    assert units_of(backfill_plan(symbols, dt.date(2024, 2, 1), dt.date(2024, 1, 1))) == []


def test_plan_ends_with_the_last_complete_month(spark):
    symbols = spark.createDataFrame([("A",)], "symbol string")
    first, last = units_of(backfill_plan(symbols))[0], units_of(backfill_plan(symbols))[-1]
    before = dt.date.today().replace(day=1) - dt.timedelta(days=1)
    assert first == ("A", "2023", "01") and last == ("A", f"{before:%Y}", f"{before:%m}")


def test_plan_has_no_cross_join(spark):
    plan = backfill_plan(spark.createDataFrame([("A",)], "symbol string"))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_due_units(spark, make_landing, make_table):
    landing, table = make_landing(), make_table(with_symbol=True)
    land_raw(spark, landing, raw_frame(spark, [("A", "2023", "01", "2023-01-05 00:00", 1.0)]))
    load_units(spark, landing, table, keys=["symbol", "event_time"])
    symbols = spark.createDataFrame([("A",), ("B",)], "symbol string")
    plan = backfill_plan(symbols, dt.date(2023, 1, 1), dt.date(2023, 2, 1))
    february = [("A", "2023", "02"), ("B", "2023", "02")]
    assert units_of(not_landed(spark, plan, landing)) == sorted([*february, ("B", "2023", "01")])
    assert units_of(missing_months(spark, plan, table)) == february
    assert units_of(missing_months(spark, plan, table, by_symbol=True)) == sorted([*february, ("B", "2023", "01")])


def test_load_month(spark, make_landing, make_table):
    landing, table = make_landing(), make_table()
    rows = [("A", "2023", "01", "2023-01-01 00:00", 1.0), ("A", "2023", "01", "2023-02-01 00:00", 2.0),
            ("A", "2023", "01", None, 3.0), ("A", "2023", "02", "2023-02-02 00:00", 4.0)]
    land_raw(spark, landing, raw_frame(spark, rows))
    done = load_month(spark, landing, table, "A", 2023, 1)
    assert (done.source, done.inserted, done.updated, done.rejected) == (3, 2, 0, 1)
    loaded = [(at("2023-01-01"), 1.0), (at("2023-02-01"), 2.0)]
    assert bars(spark.table(table)) == loaded
    again = load_month(spark, landing, table, "A", "2023", "01")
    assert (again.inserted, again.updated) == (0, 2) and bars(spark.table(table)) == loaded
    assert load_month(spark, landing, table, "A", 2023, 2, skip_if_exists=True) is None
    assert bars(spark.table(table)) == loaded
    with pytest.raises(MissingRawFile):
        load_month(spark, landing, table, "A", 2023, 3)


def test_append_if_missing_skips_months_with_any_row(spark, make_landing, make_table):
    landing, table = make_landing(), make_table()
    load = [("A", "2023", "01", "2023-01-01 00:00", 1.0)]
    land_raw(spark, landing, raw_frame(spark, load))
    append_if_missing(spark, landing, table)
    more = [("A", "2023", "01", "2023-01-02 00:00", 2.0), ("A", "2023", "02", "2023-02-01 00:00", 3.0)]
    land_raw(spark, landing, raw_frame(spark, more), force=True)
    for _ in range(2):
        append_if_missing(spark, landing, table)
    assert [c for _, c in bars(spark.table(table))] == [1.0, 3.0]


def test_backfill_lands_and_loads(spark, make_landing, make_table, tmp_path):
    landing, table, zips = make_landing(), make_table(with_symbol=True), tmp_path / "zips"
    for symbol, close in (("A", 1.0), ("B", 2.0)):
        write_zip(zips / f"{symbol}-1m-2023-01.zip", csv_line("2023-01-01 00:00", close))
    write_zip(zips / "A-1m-2022-12.zip", csv_line("2022-12-01 00:00", 9.0))
    symbols = spark.createDataFrame([("A",), ("B",)], "symbol string")
    plan = backfill_plan(symbols, dt.date(2023, 1, 1), dt.date(2023, 2, 1))
    for inserted in (2, 0):
        done = backfill_run(spark, landing, table, plan, str(zips), keys=["symbol", "event_time"])
        assert (done.merged.source, done.merged.inserted) == (2, inserted)
        assert units_of(done.not_landed) == [("A", "2023", "02"), ("B", "2023", "02")]
    assert [c for _, c in bars(spark.table(table))] == [1.0, 2.0]


def test_files_landed_by_others_are_loaded(spark, make_table, tmp_path):
    table = make_table(with_symbol=True)
    for symbol, month, close in (("A", "01", 1.0), ("B", "01", 2.0), ("A", "02", 3.0)):
        path = tmp_path / f"raw/year=2023/month={month}/{symbol}-1m-2023-{month}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(csv_line(f"2023-{month}-01 00:00", close))
    units = spark.createDataFrame([("A", "2023", "01"), ("A", "2023", "02")], "symbol string, year string, month string")
    raw = lambda units: scan_named_files(spark, str(tmp_path / "raw"), units)
    assert load_raw(spark, table, raw(units), ["symbol", "event_time"]).inserted == 2
    done = load_raw(spark, table, raw(None), ["symbol", "event_time"])
    assert (done.updated, done.inserted) == (2, 1)
    rows = spark.table(table).select("symbol", "close").collect()
    assert sorted(tuple(r) for r in rows) == [("A", 1.0), ("A", 3.0), ("B", 2.0)]
