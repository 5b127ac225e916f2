"""Which units are due, and one job that lands and loads them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.functions.calendar import month_start, zero_pad
from barlake.operators.landing import land_archives
from barlake.operators.upsert import DEFAULT_KEYS, MergeResult
from barlake.operators.months import loaded_units, months_not_loaded
from barlake.plans.load import load_units
from barlake.schema import MONTH_COLUMN, UNIT_COLUMNS
from barlake.sources.manifest import landed_units, missing_from

# Fixed value: first month of the history.
HISTORY_START = dt.date(2023, 1, 1)


@dataclass(frozen=True)
class BackfillResult:
    merged: MergeResult
    not_landed: DataFrame


def backfill_plan(symbols: DataFrame, start: dt.date = HISTORY_START, end: dt.date | None = None) -> DataFrame:
    """Units of every month from ``start`` to ``end``, for every symbol.

    ``end`` is the last month included; by default the last complete one.
    """
    first = F.trunc(F.lit(start), "MM")
    last = F.add_months(F.trunc(F.current_date(), "MM"), -1) if end is None else F.trunc(F.lit(end), "MM")
    # A sequence that ends before it starts would count down.
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    due = symbols.select("symbol").distinct().withColumn(MONTH_COLUMN, F.explode(months))
    return due.select(
        "symbol",
        F.year(MONTH_COLUMN).cast("string").alias("year"),
        zero_pad(F.month(MONTH_COLUMN)).alias("month"),
    )


def not_landed(spark: SparkSession, plan: DataFrame, landing: str) -> DataFrame:
    """Planned units still to be landed."""
    return missing_from(plan.select(*UNIT_COLUMNS), landed_units(spark, landing))


def missing_months(spark: SparkSession, plan: DataFrame, table: str, by_symbol: bool = False) -> DataFrame:
    """Planned units still to be loaded.

    A month counts as loaded for every symbol, unless ``by_symbol`` looks into
    a table that stores the symbol.
    """
    due = plan.select(*UNIT_COLUMNS, month_start(F.col("year"), F.col("month")).alias(MONTH_COLUMN))
    if by_symbol:
        first, last = due.agg(F.min(MONTH_COLUMN), F.max(MONTH_COLUMN)).first()
        months = [row[0] for row in due.select(MONTH_COLUMN).distinct().collect()]
        months_not_loaded(spark, table, months)
        loaded = loaded_units(spark, table, first, last)
        due = due.join(loaded, ["symbol", MONTH_COLUMN], "left_anti")
    else:
        months = [row[0] for row in due.select(MONTH_COLUMN).distinct().collect()]
        due = due.filter(F.col(MONTH_COLUMN).isin(months_not_loaded(spark, table, months)))
    return due.select(*UNIT_COLUMNS)


def backfill_run(
    spark: SparkSession,
    landing: str,
    table: str,
    plan: DataFrame,
    archives: str | None = None,
    keys: Sequence[str] = DEFAULT_KEYS,
    time_unit: str | Column = "ms",
) -> BackfillResult:
    """Land what is missing, then upsert every planned unit in one job.

    Planned units that could not be landed are returned, not loaded.
    """
    if archives is not None:
        land_archives(spark, landing, archives, plan)
    merged = load_units(spark, landing, table, plan, keys, time_unit)
    return BackfillResult(merged, not_landed(spark, plan, landing))
