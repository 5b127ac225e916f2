"""Column sets shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw bar CSV, no header, every field nullable.
RAW_SCHEMA = T.StructType([
    T.StructField("open_time_ms", T.LongType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("close_time_ms", T.LongType()),
    T.StructField("quote_asset_volume", T.DoubleType()),
    T.StructField("trades", T.LongType()),
    T.StructField("taker_buy_base", T.DoubleType()),
    T.StructField("taker_buy_quote", T.DoubleType()),
    T.StructField("ignore", T.StringType()),
])
RAW_COLUMNS = RAW_SCHEMA.fieldNames()

# Raw columns that the bar table does not keep.
DROPPED_COLUMNS = ["ignore", "open_time_ms", "close_time_ms"]

BAR_COLUMNS = [c for c in RAW_COLUMNS if c not in DROPPED_COLUMNS] + ["event_time"]

# A work unit is one symbol and one month; both date parts are text so that
# "01" keeps its zero.
UNIT_COLUMNS = ["symbol", "year", "month"]
UNIT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in UNIT_COLUMNS])

MONTH_COLUMN = "event_month"

# Of tables that part the symbols of a month.
BUCKET_COLUMN = "symbol_bucket"
