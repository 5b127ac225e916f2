"""What must hold after lost files, lost catalog entries, old files and bad times."""

import os
import pathlib
import time

import pytest
from pyspark.sql import functions as F

from barlake.operators import append_bars, land_raw, loaded_months, merge_into, month_exists, month_status
from barlake.operators.table import table_location
from barlake.plans import append_if_missing, load_month, load_raw, missing_months
from barlake.sources import scan_named_files
from barlake.streaming import pick_up_landed
from conftest import bars, csv_line, ms, raw_frame
from barlake.functions import to_bars

JANUARY, FEBRUARY = ("A", "2023", "01"), ("A", "2023", "02")
ROWS = [(*JANUARY, "2023-01-05 00:00", 1.0), (*FEBRUARY, "2023-02-05 00:00", 2.0)]


def folder(spark, table, *parts):
    return pathlib.Path(table_location(spark, table).removeprefix("file:"), *parts)


def empty(path):
    for file in path.iterdir():
        if file.name.endswith((".parquet", ".crc")):
            file.unlink()


def answers(spark, table):
    units = spark.createDataFrame([JANUARY, FEBRUARY], "symbol string, year string, month string")
    months = spark.sql("SELECT explode(array(date'2023-01-01', date'2023-02-01')) AS event_month")
    return [
        sorted(str(r[0]) for r in month_status(spark, table, months).filter("status = 'EXISTS'").collect()),
        sorted(str(r[0]) for r in loaded_months(spark, table).collect()),
        [m for m in ("2023-01-01", "2023-02-01") if month_exists(spark, table, m[:4], m[5:7])],
        sorted({"2023-01-01", "2023-02-01"} - {f"{r['year']}-{r['month']}-01" for r in missing_months(spark, units, table).collect()}),
    ]


def test_a_month_whose_files_are_gone_is_missing(spark, make_table, make_landing):
    table, landing = make_table(), make_landing()
    raw = raw_frame(spark, ROWS)
    append_bars(spark, table, to_bars(raw))
    assert answers(spark, table) == [["2023-01-01", "2023-02-01"]] * 4
    empty(folder(spark, table, "event_month=2023-01-01"))
    assert answers(spark, table) == [["2023-02-01"]] * 4
    land_raw(spark, landing, raw)
    append_if_missing(spark, landing, table)
    assert answers(spark, table) == [["2023-01-01", "2023-02-01"]] * 4
    assert [c for _, c in bars(spark.table(table))] == [1.0, 2.0]


def test_a_month_on_disk_only_is_there(spark, make_table):
    table = make_table()
    append_bars(spark, table, to_bars(raw_frame(spark, ROWS)))
    kept = spark.sql(f"SELECT * FROM {table}").collect()
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (event_month = date'2023-01-01')")
    other = folder(spark, table, "event_month=2023-01-01")
    if not other.exists():  # a managed catalog removes the files with the entry
        rows = spark.createDataFrame(kept, spark.table(table).schema).filter("event_month = date'2023-01-01'")
        rows.drop("event_month").write.parquet(str(other))
    months = spark.sql("SELECT date'2023-01-01' AS event_month")
    assert month_status(spark, table, months).first()["status"] == "EXISTS"
    merge_into(spark, table, to_bars(raw_frame(spark, [(*JANUARY, "2023-01-06 00:00", 3.0)])))
    assert [c for _, c in bars(spark.table(table))] == [1.0, 3.0, 2.0]


def test_landing_never_overwrites_without_force(spark, make_landing):
    landing = make_landing()
    land_raw(spark, landing, raw_frame(spark, ROWS))
    spec = "symbol = 'A', year = '2023', month = '01'"
    files = folder(spark, landing, "symbol=A", "year=2023", "month=01")
    content = {p.name: p.read_bytes() for p in files.iterdir()}
    spark.sql(f"ALTER TABLE {landing} DROP PARTITION ({spec})")
    if not files.exists():
        files.mkdir(parents=True)
        for name, data in content.items():
            (files / name).write_bytes(data)
    land_raw(spark, landing, raw_frame(spark, [(*JANUARY, "2023-01-07 00:00", 9.0)]))
    closes = [r["close"] for r in spark.table(landing).collect()]
    assert sorted(closes) == [1.0, 2.0]


def test_times_of_far_years_are_kept_out(spark, make_table):
    table = make_table()
    rows = raw_frame(spark, [*ROWS, (*JANUARY, ms("2023-01-06 00:00") * 1000, 5.0), (*JANUARY, None, 6.0)])
    done = load_raw(spark, table, rows)
    assert (done.source, done.inserted, done.rejected) == (4, 2, 2)
    assert done.rejects.count() == 2 and [c for _, c in bars(spark.table(table))] == [1.0, 2.0]
    with_nulls = merge_into(spark, table, to_bars(rows).filter("close > 4"), null_keys="insert")
    assert (with_nulls.inserted, with_nulls.rejected) == (1, 1)


def test_time_units_by_row(spark, make_table):
    table = make_table()
    mixed = raw_frame(spark, [*ROWS, (*JANUARY, ms("2023-01-06 00:00") * 1000, 5.0)])
    unit = F.when(F.col("close") == 5, "us").otherwise("ms")
    assert load_raw(spark, table, mixed, time_unit=unit).rejected == 0
    assert [(str(t), c) for t, c in bars(spark.table(table))][1] == ("2023-01-06 00:00:00", 5.0)


def test_one_unit_asks_for_one_partition(spark, make_table, make_landing, monkeypatch):
    table, landing, sent = make_table(), make_landing(), []
    land_raw(spark, landing, raw_frame(spark, ROWS))
    run = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (sent.append(text), run(self, text, *a, **k))[1])
    load_month(spark, landing, table, *JANUARY)
    shown = [s for s in sent if s.startswith("SHOW PARTITIONS")]
    assert shown and all("PARTITION (symbol = 'A', year = '2023', month = '01')" in s for s in shown)


@pytest.fixture
def named(tmp_path):
    def write(symbol, month, close, age_days=0):
        path = tmp_path / "named" / "year=2023" / f"month={month}" / f"{symbol}-1m-2023-{month}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(csv_line(f"2023-{month}-05 00:00", close) + "\n")
        then = time.time() - 86_400 * age_days
        os.utime(path, (then, then))
        return str(tmp_path / "named")

    return write


@pytest.mark.parametrize("max_files", [1, 10_000])
def test_the_stream_takes_old_and_named_files(spark, make_table, named, tmp_path, max_files):
    table = make_table(with_symbol=True)
    run = lambda: pick_up_landed(
        spark, named("A", "01", 1.0), table, str(tmp_path / "checkpoint"), ["symbol", "event_time"], max_files
    ).awaitTermination()
    run()
    named("B", "01", 2.0, age_days=30)
    named("B", "02", 3.0, age_days=400)
    run()
    got = sorted((r["symbol"], r["close"]) for r in spark.table(table).collect())
    assert got == [("A", 1.0), ("B", 2.0), ("B", 3.0)]


def test_the_stream_refuses_keys_that_mix_symbols(spark, make_table, tmp_path):
    with pytest.raises(ValueError, match="symbol"):
        pick_up_landed(spark, str(tmp_path), make_table(with_symbol=True), str(tmp_path / "checkpoint"))


def test_files_without_a_unit_give_no_rows(spark, named):
    root = named("A", "01", 1.0)
    (pathlib.Path(root) / "year=2023" / "month=01" / "notes.csv").write_text(csv_line("2023-01-01 00:00", 7.0))
    assert [(r["symbol"], r["close"]) for r in scan_named_files(spark, root).collect()] == [("A", 1.0)]
