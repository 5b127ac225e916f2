"""Questions about months of a bar table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.functions.calendar import utc_literal
from barlake.operators.partitions import listed_partitions, loaded_partitions
from barlake.operators.table import bucket_of, current, symbol_buckets
from barlake.schema import BUCKET_COLUMN, MONTH_COLUMN


def _first_day(year: int | str, month: int | str) -> dt.date:
    return dt.date(int(year), int(month), 1)


def _day_after_month(first: dt.date) -> dt.date:
    return (first + dt.timedelta(days=31)).replace(day=1)


def month_range(
    bars: DataFrame, year: int | str, month: int | str, symbol: str | None = None, buckets: int = 0
) -> DataFrame:
    """Rows with ``event_time`` in one month.

    Catalyst does not derive the partition from the time, so the partition
    predicate, which prunes, is added to the half-open time range. ``buckets`` of the table, if it has any, let
    the symbol prune as well.
    """
    first = _first_day(year, month)
    time = F.col("event_time")
    rows = bars.filter(
        (F.col(MONTH_COLUMN) == F.lit(first))
        & (time >= utc_literal(first))
        & (time < utc_literal(_day_after_month(first)))
    )
    if symbol is None:
        return rows
    if buckets:
        (number,) = bars.sparkSession.range(1).select(bucket_of(F.lit(symbol), buckets)).first()
        rows = rows.filter(F.col(BUCKET_COLUMN) == number)
    return rows.filter(F.col("symbol") == symbol)


def month_exists(
    spark: SparkSession, table: str, year: int | str, month: int | str, symbol: str | None = None
) -> bool:
    """Does the month hold any row?

    ``take`` starts one task, and more only while no row has been found; a
    count over a limit, or ``isEmpty``, would start one for every file. Only if there is none, the folder is
    asked as well: the month may be on disk and not in the catalog.
    """
    buckets = symbol_buckets(spark, table) if symbol is not None else 0
    holds_row = lambda: bool(
        month_range(current(spark, table), year, month, symbol, buckets).select(F.lit(1)).take(1)
    )
    return holds_row() or (not months_not_loaded(spark, table, [_first_day(year, month)]) and holds_row())


def loaded_months(spark: SparkSession, table: str) -> DataFrame:
    """Months of the catalog that hold rows, by the files in their folders; no file is opened."""
    listed = sorted({p[0] for p in listed_partitions(spark, table) if p[0] is not None})
    held = {p[0] for p in loaded_partitions(spark, table, listed)}
    return spark.createDataFrame([(m,) for m in listed if m in held], f"{MONTH_COLUMN} date")


def months_not_loaded(spark: SparkSession, table: str, months: list[dt.date]) -> list[dt.date]:
    """Those of ``months`` without rows: no partition of the month has a file, see ``loaded_partitions``."""
    held = {p[0] for p in loaded_partitions(spark, table, months)}
    return [m for m in months if m not in held]


def loaded_units(spark: SparkSession, table: str, first: dt.date, last: dt.date) -> DataFrame:
    """(symbol, month) pairs with rows between two months; reads the symbol column only."""
    bars = current(spark, table).filter(F.col(MONTH_COLUMN).between(F.lit(first), F.lit(last)))
    return bars.select("symbol", MONTH_COLUMN).distinct()


def month_status(spark: SparkSession, table: str, months: DataFrame) -> DataFrame:
    """``EXISTS`` or ``MISSING`` for every requested ``event_month``.

    The driver sees one row per calendar month.
    """
    asked = [row[0] for row in months.select(MONTH_COLUMN).na.drop().distinct().collect()]
    absent = months_not_loaded(spark, table, asked)
    there = F.col(MONTH_COLUMN).isin([m for m in asked if m not in absent])
    return months.select(MONTH_COLUMN, F.when(there, "EXISTS").otherwise("MISSING").alias("status"))
