"""Month arithmetic that gives the same answer in every session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

_DAY_SECONDS = 86_400
_EPOCH = dt.date(1970, 1, 1)


def month_of(ts: Column) -> Column:
    """First day of the UTC month of an instant.

    ``trunc(ts, 'MM')`` would follow the session time zone and move bars of the
    first hours of a month into the month before; epoch days do not.
    """
    day = F.floor(F.unix_seconds(ts) / _DAY_SECONDS).cast("int")
    return F.trunc(F.date_from_unix_date(day), "MM")


def utc_literal(day: dt.date) -> Column:
    """Midnight UTC of a day as a constant instant."""
    return F.timestamp_seconds(F.lit((day - _EPOCH).days * _DAY_SECONDS))


def month_start(year: Column, month: Column) -> Column:
    """First day of a month given as numbers or as text such as ``"01"``."""
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def next_month(start: Column) -> Column:
    """First day of the following month; December rolls over to January."""
    return F.add_months(start, 1)


def month_bounds(units: DataFrame) -> DataFrame:
    """Add the half-open range ``[month_start, month_end)`` of each unit."""
    start = month_start(F.col("year"), F.col("month"))
    return units.withColumn("month_start", start).withColumn("month_end", next_month(start))


def zero_pad(month: Column) -> Column:
    """Two-digit month. Unlike ``lpad`` this never cuts a longer number."""
    return F.format_string("%02d", month.cast("int"))
