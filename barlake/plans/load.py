"""Loading landed units into the bar table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.functions.bars import to_bars
from barlake.functions.calendar import month_start
from barlake.operators.landing import scan_landed
from barlake.operators.upsert import DEFAULT_KEYS, MergeResult, merge_into
from barlake.operators.months import month_exists, months_not_loaded
from barlake.operators.table import append_bars
from barlake.schema import MONTH_COLUMN, UNIT_SCHEMA
from barlake.sources.manifest import landed_units, unit_is_landed
from barlake.sources.units import unit_label

_UNIT_LABEL = "unit_label"


class MissingRawFile(Exception):
    """The unit has not been landed."""


def _one_unit(spark: SparkSession, symbol: str, year: int | str, month: int | str) -> DataFrame:
    return spark.createDataFrame([(symbol, str(year), str(month).zfill(2))], UNIT_SCHEMA)


def load_raw(
    spark: SparkSession,
    table: str,
    raw: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    time_unit: str | Column = "ms",
) -> MergeResult:
    """Upsert raw rows with unit columns, from whatever source, in one job.

    The table ends up as if the units had been loaded one after another by
    month, then symbol.
    """
    bars = to_bars(raw.withColumn(_UNIT_LABEL, unit_label()), time_unit)
    return merge_into(spark, table, bars, keys, unit=_UNIT_LABEL)


def load_units(
    spark: SparkSession,
    landing: str,
    table: str,
    units: DataFrame | None = None,
    keys: Sequence[str] = DEFAULT_KEYS,
    time_unit: str | Column = "ms",
) -> MergeResult:
    """Upsert landed units, all of them in one job."""
    return load_raw(spark, table, scan_landed(spark, landing, units), keys, time_unit)


def load_month(
    spark: SparkSession,
    landing: str,
    table: str,
    symbol: str,
    year: int | str,
    month: int | str,
    keys: Sequence[str] = DEFAULT_KEYS,
    skip_if_exists: bool = False,
    time_unit: str | Column = "ms",
) -> MergeResult | None:
    """Upsert one landed unit; ``None`` when skipped because the month holds rows."""
    unit = _one_unit(spark, symbol, year, month)
    if not unit_is_landed(spark, landing, symbol, year, month):
        raise MissingRawFile(f"{symbol} {year}-{month} has not been landed")
    if skip_if_exists:
        by_symbol = symbol if "symbol" in keys else None
        if month_exists(spark, table, year, month, by_symbol):
            return None
    return load_units(spark, landing, table, unit, keys, time_unit)


def append_if_missing(
    spark: SparkSession, landing: str, table: str, units: DataFrame | None = None, time_unit: str | Column = "ms"
) -> None:
    """Append the units whose month holds no row yet; skip the others whole.

    Existence is checked once, before anything is written. Any row makes a month
    count as loaded, so a month loaded in part is not completed: use
    ``load_units`` for that.
    """
    planned = landed_units(spark, landing) if units is None else units
    due = planned.withColumn(MONTH_COLUMN, month_start(F.col("year"), F.col("month")))
    months = [row[MONTH_COLUMN] for row in due.select(MONTH_COLUMN).distinct().collect()]
    missing = due.filter(F.col(MONTH_COLUMN).isin(months_not_loaded(spark, table, months)))
    append_bars(spark, table, to_bars(scan_landed(spark, landing, missing), time_unit))
