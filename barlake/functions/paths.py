"""File names and paths of work units, built as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from barlake.functions.calendar import zero_pad


def _bar_file(extension: str) -> Column:
    month = zero_pad(F.col("month"))
    return F.concat(F.col("symbol"), F.lit("-1m-"), F.col("year"), F.lit("-"), month, F.lit(extension))


def archive_name() -> Column:
    """``{symbol}-1m-{yyyy}-{mm}.zip`` of a unit row."""
    return _bar_file(".zip")


def landed_path(dataset: str) -> Column:
    """``{dataset}/year={yyyy}/month={mm}/{symbol}-1m-{yyyy}-{mm}.csv`` of a unit row."""
    return F.concat_ws(
        "/",
        F.lit(dataset),
        F.concat(F.lit("year="), F.col("year")),
        F.concat(F.lit("month="), zero_pad(F.col("month"))),
        _bar_file(".csv"),
    )


def task_id(prefix: str) -> Column:
    """``{prefix}_{symbol in lower case}``."""
    return F.concat_ws("_", F.lit(prefix), F.lower("symbol"))


def trim_whitespace(text: Column) -> Column:
    """Strip every kind of white space; SQL ``trim`` strips blanks only."""
    space = r"[\s\x1c-\x1f]+"
    return F.regexp_replace(F.regexp_replace(text, f"(?U)^{space}", ""), f"(?U){space}$", "")
