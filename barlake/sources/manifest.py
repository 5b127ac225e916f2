"""Which units are there already."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.schema import UNIT_COLUMNS
from barlake.sources.units import has_unit_name, units_from_name


def partition_value(name: str):
    """One value out of a ``SHOW PARTITIONS`` line such as ``a=1/b=2``."""
    raw = F.regexp_extract("partition", f"(?:^|/){name}=([^/]*)", 1)
    return F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))).alias(name)


def landed_units(spark: SparkSession, landing: str) -> DataFrame:
    """Units in a landing table, from the catalog; no file is listed or opened."""
    return spark.sql(f"SHOW PARTITIONS {landing}").select(*(partition_value(c) for c in UNIT_COLUMNS))


def partition_spec(unit: Sequence[str]) -> str:
    quote = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return "PARTITION (" + ", ".join(f"{c} = {quote(v)}" for c, v in zip(UNIT_COLUMNS, unit)) + ")"


def unit_is_landed(spark: SparkSession, landing: str, symbol: str, year: int | str, month: int | str) -> bool:
    """Whether the catalog has one unit; it is asked for no other."""
    spec = partition_spec((symbol, str(year), str(month).zfill(2)))
    return not spark.sql(f"SHOW PARTITIONS {landing} {spec}").isEmpty()


def file_manifest(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Files whose name carries the unit, with size and time.

    ``content`` is not selected, so no file body is read. Other errors than an
    empty folder rise: an unreadable store is not an empty one.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return files.filter(has_unit_name(F.col("path"))).select(
        *units_from_name(F.col("path")), "path", "length", "modificationTime"
    )


def units_exist(units: DataFrame, manifest: DataFrame) -> DataFrame:
    """Every requested unit with a ``row_exists`` flag: one join, not one probe per unit."""
    there = manifest.select(*UNIT_COLUMNS).distinct().withColumn("there", F.lit(True))
    return (
        units.select(*UNIT_COLUMNS)
        .join(there, UNIT_COLUMNS, "left")
        .select(*UNIT_COLUMNS, F.col("there").isNotNull().alias("row_exists"))
    )


def missing_from(units: DataFrame, manifest: DataFrame) -> DataFrame:
    """Requested units that the manifest does not hold."""
    return units.join(manifest.select(*UNIT_COLUMNS).distinct(), UNIT_COLUMNS, "left_anti")
