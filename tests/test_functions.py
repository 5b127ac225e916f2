import datetime as dt

import pytest
from pyspark.sql import functions as F

from barlake.functions import archive_name, landed_path, month_bounds, month_of, task_id, to_bars, trim_whitespace, zero_pad
from barlake.schema import BAR_COLUMNS
from conftest import at, ms, raw_frame


def test_to_bars_columns_and_time(spark):
    rows = to_bars(raw_frame(spark, [("A", "2023", "01", "2023-01-31 23:59", 7.0)]).drop("symbol", "year", "month"))
    assert sorted(rows.columns) == sorted(BAR_COLUMNS)
    row = rows.first()
    assert (row["event_time"], row["close"]) == (at("2023-01-31 23:59"), 7.0)


def test_time_units(spark):
    raw = spark.createDataFrame([(ms("2025-01-01") * 1000,)], "open_time_ms long")
    assert to_bars(raw, "us").first()["event_time"] == at("2025-01-01")
    as_ms = to_bars(raw).select(F.year("event_time").alias("year"))
    assert as_ms.first()["year"] == 56971
    with pytest.raises(ValueError):
        to_bars(raw, "s")


def test_time_matches_division_by_a_thousand(spark):
    """Over whole seconds; between them the double can fall a microsecond short."""
    raw = spark.range(0, 200_000).select((F.col("id") * 17_341_000).alias("open_time_ms"))
    both = to_bars(raw.withColumn("divided", (F.col("open_time_ms") / 1000).cast("timestamp")))
    assert both.filter(F.col("divided") != F.col("event_time")).isEmpty()


@pytest.mark.parametrize("value", [None, 2**63 - 1, -(2**63)])
def test_time_no_timestamp_can_hold_is_null(spark, value):
    raw = spark.createDataFrame([(value,)], "open_time_ms long")
    assert to_bars(raw).first()["event_time"] is None


@pytest.mark.parametrize("text, first", [
    ("2023-01-01 00:00:00", "2023-01-01"),
    ("2023-12-31 23:59:59.999", "2023-12-01"),
    ("2024-02-29 12:00", "2024-02-01"),
    ("1969-12-31 23:59:59.999", "1969-12-01"),
])
def test_month_does_not_follow_the_session_zone(new_york, text, first):
    row = to_bars(new_york.createDataFrame([(ms(text),)], "open_time_ms long"))
    assert row.select(month_of(F.col("event_time"))).first()[0] == dt.date.fromisoformat(first)


def test_month_bounds(spark):
    units = spark.createDataFrame(
        [("A", "2023", "12"), ("A", "2024", "02"), ("A", "2023", "1")], "symbol string, year string, month string"
    )
    got = [(str(r["month_start"]), str(r["month_end"])) for r in month_bounds(units).collect()]
    assert got == [("2023-12-01", "2024-01-01"), ("2024-02-01", "2024-03-01"), ("2023-01-01", "2023-02-01")]


def test_names(spark):
    unit = spark.createDataFrame([("BTCUSDT", "2023", 1)], "symbol string, year string, month int")
    row = unit.select(archive_name(), landed_path("bars"), task_id("load"), zero_pad(F.lit(123))).first()
    assert list(row) == [
        "BTCUSDT-1m-2023-01.zip", "bars/year=2023/month=01/BTCUSDT-1m-2023-01.csv", "load_btcusdt", "123"
    ]


@pytest.mark.parametrize("text", ["  a b\t", "\x0b\x1c a\x85", " a ", "", " \t "])
def test_trim_is_python_strip(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(trim_whitespace(F.col("t"))).first()[0] == text.strip()
