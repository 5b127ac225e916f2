import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from barlake.schema import RAW_COLUMNS
from barlake.sources import (
    archive_manifest,
    file_manifest,
    missing_from,
    only_units,
    read_archives,
    read_symbols,
    scan_bars_csv,
    scan_named_files,
    units_exist,
    unzip_bars,
)
from barlake.sources import units as units_module
from conftest import csv_line, ms, write_zip

HEADER = "open_time,open,high,low,close,volume,close_time,quote,count,base,quote2,ignore"
GOOD = csv_line("2023-01-01 00:01", 5.5)
EDGE_LINES = [
    HEADER,
    GOOD,
    "",
    "   ",
    csv_line("2023-01-01 00:02").replace("0.5", "x", 1),
    ",".join(csv_line("2023-01-01 00:03").split(",")[:11]),
    csv_line("2023-01-01 00:04") + ",extra",
    csv_line(None),
    f'"{ms("2023-01-01 00:05")}", 1.50 ,2,3,4,5,6,7,8,9,10,"a,b"',
]
UNIT_DDL = "symbol string, year string, month string"


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*RAW_COLUMNS).collect())))


def test_permissive_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(EDGE_LINES))
    rows = scan_bars_csv(spark, str(tmp_path / "a.csv")).collect()
    assert len(rows) == 7
    assert [r["open_time_ms"] is None for r in rows] == [True, False, False, False, False, True, False]
    header, good, bad_number, short, long, _, _ = rows
    assert header["close"] is None and header["ignore"] == "ignore"
    assert good["close"] == 5.5
    assert bad_number["low"] is None and bad_number["high"] == 2.0
    assert short["ignore"] is None and long["ignore"] == "0"


def test_corrupt_column_keeps_the_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([GOOD, HEADER]))
    rows = scan_bars_csv(spark, str(tmp_path / "a.csv"), "bad").select("open", "bad").collect()
    assert [r["bad"] for r in rows] == [None, HEADER]


def test_empty_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert scan_bars_csv(spark, str(tmp_path / "a.csv")).count() == 0


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
@pytest.mark.parametrize("bom", ["", "﻿"])
def test_archive_rows_equal_file_rows(spark, tmp_path, newline, bom):
    text = bom + newline.join(EDGE_LINES)
    (tmp_path / "a.csv").write_bytes(text.encode())
    write_zip(tmp_path / "zips" / "A-1m-2023-01.zip", text.encode())
    unzipped = unzip_bars(read_archives(spark, str(tmp_path / "zips")))
    assert rows_of(unzipped) == rows_of(scan_bars_csv(spark, str(tmp_path / "a.csv")))
    assert unzipped.select("symbol", "year", "month").distinct().collect() == [("A", "2023", "01")]


def test_archive_larger_than_a_block(spark, tmp_path):
    start = ms("2023-01-01")
    lines = [csv_line(start + i * 60_000, float(i)) for i in range(44_640)]
    write_zip(tmp_path / "A-1m-2023-01.zip", "\n".join(lines))
    got = unzip_bars(read_archives(spark, str(tmp_path))).agg(
        F.count("*"), F.countDistinct("open_time_ms"), F.sum("close")
    ).first()
    assert tuple(got) == (44_640, 44_640, float(sum(range(44_640))))


def test_archive_without_csv_is_an_error(spark, tmp_path):
    write_zip(tmp_path / "A-1m-2023-01.zip", GOOD, "notes.txt")
    with pytest.raises(PythonException, match="no CSV in archive A-2023-01"):
        unzip_bars(read_archives(spark, str(tmp_path))).collect()


def test_bodies_of_other_archives_are_not_read(spark, tmp_path):
    write_zip(tmp_path / "A-1m-2023-01.zip", GOOD)
    (tmp_path / "B-1m-2023-01.zip").write_bytes(b"not a zip")
    units = spark.createDataFrame([("A", "2023", "01")], UNIT_DDL)
    wanted = read_archives(spark, str(tmp_path), units)
    assert unzip_bars(wanted).count() == 1
    listed = {r["symbol"] for r in archive_manifest(spark, str(tmp_path)).collect()}
    assert listed == {"A", "B"}


@pytest.fixture
def named_files(tmp_path):
    for symbol, year, month in [("A", "2023", "01"), ("B", "2023", "01"), ("A", "2023", "02")]:
        path = tmp_path / f"year={year}/month={month}/{symbol}-1m-{year}-{month}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(csv_line(f"{year}-{month}-01 00:00") + "\n")
    return str(tmp_path)


def test_named_files(spark, named_files):
    units = spark.createDataFrame([("A", "2023", "01"), ("B", "2023", "02")], UNIT_DDL)
    everything = scan_named_files(spark, named_files)
    assert sorted(tuple(r) for r in everything.select("symbol", "year", "month").collect()) == [
        ("A", "2023", "01"), ("A", "2023", "02"), ("B", "2023", "01")
    ]
    one = scan_named_files(spark, named_files, units)
    assert [tuple(r) for r in one.select("symbol", "year", "month").collect()] == [("A", "2023", "01")]


def test_named_files_of_other_symbols_are_skipped(spark, named_files):
    """Files are dropped by name before they are opened."""
    units = spark.createDataFrame([("B", "2023", "01")], UNIT_DDL)
    df = scan_named_files(spark, named_files, units)
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    leaf = plan.collectLeaves().head()
    leaf = leaf.inputPlan().collectLeaves().head() if leaf.nodeName().startswith("Adaptive") else leaf
    assert leaf.metrics().apply("numFiles").value() == 1


def test_manifest_and_exists(spark, named_files):
    manifest = file_manifest(spark, named_files)
    assert manifest.filter("length > 0 and modificationTime is not null").count() == 3
    assert "content" not in manifest._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    units = spark.createDataFrame([("A", "2023", "01"), ("B", "2023", "02")], UNIT_DDL)
    assert {tuple(r) for r in units_exist(units, manifest).collect()} == {
        ("A", "2023", "01", True), ("B", "2023", "02", False)
    }
    assert [tuple(r) for r in missing_from(units, manifest).collect()] == [("B", "2023", "02")]


def test_many_units_take_the_join(spark, named_files, monkeypatch):
    units = spark.createDataFrame([("A", "2023", "01"), ("B", "2023", "02"), ("B", "2023", "01")], UNIT_DDL)
    raw = scan_named_files(spark, named_files)
    few = only_units(raw, units)
    monkeypatch.setattr(units_module, "MAX_LITERAL_UNITS", 1)
    many = only_units(raw, units)
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "strategy=broadcast" not in plan
    assert rows_of(few) == rows_of(many) and few.count() == 2
    assert only_units(raw, units.limit(0)).count() == 0


def test_symbols(spark, tmp_path):
    path = tmp_path / "symbols.txt"
    path.write_text("# list\n\n BTCUSDT \n#ETHUSDT\n  # BNBUSDT\n\t\nSOLUSDT \nBTCUSDT\n")
    assert [r[0] for r in read_symbols(spark, str(path)).collect()] == ["BTCUSDT", "SOLUSDT", "BTCUSDT"]
    assert [r[0] for r in read_symbols(spark, str(tmp_path / "none.txt")).collect()] == ["BTCUSDT"]
