import pytest

from barlake.operators import create_landing_table, land_archives, land_raw, scan_landed
from barlake.sources import landed_units, scan_bars_csv
from barlake.sources import units as units_module
from conftest import csv_line, raw_frame, write_zip

UNIT_DDL = "symbol string, year string, month string"


def closes(spark, landing, units=None):
    rows = scan_landed(spark, landing, units).select("symbol", "year", "month", "close").collect()
    return sorted(tuple(r) for r in rows)


def test_landing_keeps_rows_units_and_zeros(spark, make_landing):
    landing = make_landing()
    raw = raw_frame(spark, [("A", "2023", "01", "2023-01-01 00:00", 1.25), ("A", "2023", "12", None, None)])
    land_raw(spark, landing, raw)
    assert sorted(map(repr, scan_landed(spark, landing).select(*raw.columns).collect())) == sorted(map(repr, raw.collect()))
    assert {tuple(r) for r in landed_units(spark, landing).collect()} == {("A", "2023", "01"), ("A", "2023", "12")}


def test_landed_units_are_skipped_or_replaced(spark, make_landing):
    landing = make_landing()
    first = [("A", "2023", "01", "2023-01-01 00:00", 1.0), ("B", "2023", "01", "2023-01-01 00:00", 2.0)]
    second = [("A", "2023", "01", "2023-01-01 00:00", 8.0), ("A", "2023", "02", "2023-02-01 00:00", 9.0)]
    land_raw(spark, landing, raw_frame(spark, first))
    land_raw(spark, landing, raw_frame(spark, second))
    assert closes(spark, landing) == [("A", "2023", "01", 1.0), ("A", "2023", "02", 9.0), ("B", "2023", "01", 2.0)]
    land_raw(spark, landing, raw_frame(spark, second), force=True)
    assert closes(spark, landing) == [("A", "2023", "01", 8.0), ("A", "2023", "02", 9.0), ("B", "2023", "01", 2.0)]


def test_scan_reads_only_the_folders_of_the_units(spark, make_landing):
    landing = make_landing()
    land_raw(spark, landing, raw_frame(spark, [(s, "2023", m, f"2023-{m}-01 00:00", 1.0) for s in "AB" for m in ("01", "02")]))
    units = spark.createDataFrame([("A", "2023", "02"), ("B", "2023", "01")], UNIT_DDL)
    assert closes(spark, landing, units) == [("A", "2023", "02", 1.0), ("B", "2023", "01", 1.0)]
    files = scan_landed(spark, landing, units).inputFiles()
    assert len(files) == 2 and all("symbol=A/year=2023/month=02" in f or "symbol=B/year=2023/month=01" in f for f in files)


@pytest.mark.parametrize("literals", [5_000, 0])
def test_archives_land_unchanged_and_once(spark, make_landing, tmp_path, monkeypatch, literals):
    monkeypatch.setattr(units_module, "MAX_LITERAL_UNITS", literals)
    landing, zips = make_landing(), tmp_path / "zips"
    lines = ["open_time,header", csv_line("2023-01-01 00:00", 1.0), "1,x,3"]
    write_zip(zips / "A-1m-2023-01.zip", "\n".join(lines))
    write_zip(zips / "B-1m-2023-01.zip", csv_line("2023-01-01 00:00", 2.0))
    only_a = spark.createDataFrame([("A", "2023", "01")], UNIT_DDL)
    land_archives(spark, landing, str(zips), only_a)
    assert [tuple(r) for r in landed_units(spark, landing).collect()] == [("A", "2023", "01")]
    stored = [r[0] for r in spark.read.text(scan_landed(spark, landing).inputFiles()).select("value").collect()]
    assert sorted(stored) == sorted(lines)
    raw_file = tmp_path / "raw.csv"
    raw_file.write_text("\n".join(lines))
    expected = scan_bars_csv(spark, str(raw_file))
    got = scan_landed(spark, landing).select(*expected.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))

    (zips / "A-1m-2023-01.zip").write_bytes(b"no longer a zip")
    land_archives(spark, landing, str(zips))
    assert {r[0] for r in landed_units(spark, landing).collect()} == {"A", "B"}

    write_zip(zips / "A-1m-2023-01.zip", csv_line("2023-01-01 00:00", 5.0))
    land_archives(spark, landing, str(zips), only_a, force=True)
    assert closes(spark, landing) == [("A", "2023", "01", 5.0), ("B", "2023", "01", 2.0)]


def test_known_location_can_be_registered_again(spark, make_landing, tmp_path):
    landing = make_landing()
    land_raw(spark, landing, raw_frame(spark, [("A", "2023", "01", "2023-01-01 00:00", 1.0)]))
    create_landing_table(spark, f"{landing}_again", str(tmp_path / landing))
    assert closes(spark, f"{landing}_again") == [("A", "2023", "01", 1.0)]


@pytest.mark.parametrize("missing", range(3))
def test_row_without_its_unit_is_an_error(spark, make_landing, missing):
    landing, unit = make_landing(), ["A", "2023", "01"]
    unit[missing] = None
    with pytest.raises(Exception, match="raw row without symbol, year or month"):
        land_raw(spark, landing, raw_frame(spark, [(*unit, "2023-01-01 00:00", 1.0)]))
    assert landed_units(spark, landing).isEmpty()
