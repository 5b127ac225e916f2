"""Raw bar rows to table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barlake.schema import DROPPED_COLUMNS

# Largest number of milliseconds whose microseconds still fit a 64-bit integer.
_MAX_MILLIS = (2**63 - 1) // 1000


def event_time(epoch: Column, unit: str | Column = "ms") -> Column:
    """Epoch number to instant; ``unit`` is ``"ms"`` or ``"us"``, or a column of these, and never guessed.

    A number no timestamp can hold, or a row with another unit, becomes NULL instead of failing the whole job.
    """
    if isinstance(unit, Column):
        return F.when(unit == "us", event_time(epoch, "us")).when(unit == "ms", event_time(epoch, "ms"))
    if unit == "us":
        return F.timestamp_micros(epoch)
    if unit == "ms":
        return F.when(epoch.between(-_MAX_MILLIS, _MAX_MILLIS), F.timestamp_millis(epoch))
    raise ValueError(f"unknown time unit: {unit}")


def to_bars(raw: DataFrame, unit: str | Column = "ms") -> DataFrame:
    """Add ``event_time`` and drop the raw columns the table does not keep.

    Other columns, such as a symbol, pass through.
    """
    return raw.withColumn("event_time", event_time(F.col("open_time_ms"), unit)).drop(*DROPPED_COLUMNS)
