"""Landing table: raw bars as CSV, one partition per symbol, year and month."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import islice
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.folders import as_pattern, matching
from barlake.operators.table import clustered, current, ensure_table, table_location
from barlake.schema import RAW_COLUMNS, RAW_SCHEMA, UNIT_COLUMNS
from barlake.sources.archives import archive_manifest, read_archives, unzip_lines
from barlake.sources.manifest import landed_units, missing_from, partition_spec
from barlake.sources.units import only_units

_UNITS_PER_STATEMENT = 1_000


def create_landing_table(spark: SparkSession, landing: str, location: str) -> None:
    """CSV table over ``symbol=/year=/month=`` folders.

    The symbol is a partition so that a forced rewrite of one symbol leaves the
    others of the month alone. Date parts are text and keep their zeros.
    """
    raw = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RAW_SCHEMA.fields)
    units = ", ".join(f"{c} STRING" for c in UNIT_COLUMNS)
    ensure_table(spark, landing, f"{raw}, {units}", "csv", ", ".join(UNIT_COLUMNS), location)


def scan_landed(spark: SparkSession, landing: str, units: DataFrame | None = None) -> DataFrame:
    """Raw rows of the landed units, all of them in one scan."""
    raw = current(spark, landing)
    return raw if units is None else only_units(raw, units)


def land_raw(spark: SparkSession, landing: str, raw: DataFrame, force: bool = False) -> None:
    """Write raw rows with unit columns to their partitions.

    Units landed before are skipped, or replaced with ``force``. Either way a
    unit's folder appears as a whole. A row without its unit is an error.
    """
    incomplete = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in UNIT_COLUMNS))
    error = F.raise_error(F.lit("raw row without symbol, year or month")).cast("boolean")
    raw = raw.filter(F.when(incomplete, error).otherwise(True))
    if not force:
        _register_found(spark, landing, raw)
        raw = missing_from(raw, landed_units(spark, landing))
    rows = clustered(raw.select(*RAW_COLUMNS, *UNIT_COLUMNS), *UNIT_COLUMNS)
    rows.write.mode("overwrite").insertInto(landing)


def land_archives(
    spark: SparkSession, landing: str, archives: str, units: DataFrame | None = None, force: bool = False
) -> None:
    """Unzip archives named after their unit into the landing table, text unchanged.

    Which units are missing is settled on file names, so archives of landed
    units are not opened. An archive is one unit and one task, so no shuffle.
    """
    wanted = archive_manifest(spark, archives).select(*UNIT_COLUMNS)
    if units is not None:
        wanted = only_units(wanted, units)
    if not force:
        _register_found(spark, landing, wanted)
        wanted = missing_from(wanted, landed_units(spark, landing))
    lines = unzip_lines(read_archives(spark, archives, wanted))
    (
        lines.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*UNIT_COLUMNS)
        .text(table_location(spark, landing))
    )
    _register(spark, landing, wanted)


def _chunks(units: DataFrame) -> Iterator[list[tuple[str, ...]]]:
    rows = map(tuple, units.select(*UNIT_COLUMNS).na.drop().distinct().toLocalIterator())
    while chunk := list(islice(rows, _UNITS_PER_STATEMENT)):
        yield chunk


def _add(spark: SparkSession, landing: str, units: list[tuple[str, ...]]) -> None:
    if units:
        spark.sql(f"ALTER TABLE {landing} ADD IF NOT EXISTS " + " ".join(map(partition_spec, units)))


def _register(spark: SparkSession, landing: str, units: DataFrame) -> None:
    """Tell the catalog about units written by path: these and no others, whatever their number."""
    for rows in _chunks(units):
        _add(spark, landing, rows)
    spark.catalog.refreshTable(landing)


def _register_found(spark: SparkSession, landing: str, units: DataFrame) -> None:
    """Register those of ``units`` that have files but are not in the catalog.

    A driver lost between the write and the catalog leaves such units, and so does another session.
    Taken for new they would be overwritten. The store lists each symbol's and each year's folder once.
    """
    absent = missing_from(units.select(*UNIT_COLUMNS).distinct(), landed_units(spark, landing))
    location = table_location(spark, landing)
    for rows in _chunks(absent):
        wanted = set(rows)
        values = [sorted({escaped(row[i]) for row in rows}) for i in range(len(UNIT_COLUMNS))]
        pattern = "/".join(f"{c}={{{','.join(v)}}}" for c, v in zip(UNIT_COLUMNS, values))
        there = {_unit_of(folder): folder for folder in matching(spark, f"{location}/{pattern}")}
        _add(spark, landing, [u for u in wanted & there.keys() if matching(spark, f"{as_pattern(there[u])}/[!._]*")])
    spark.catalog.refreshTable(landing)


def _unit_of(folder: str) -> tuple[str, ...]:
    return tuple(unquote(part.partition("=")[2]) for part in folder.split("/")[-len(UNIT_COLUMNS) :])


def escaped(value: str) -> str:
    """A partition value as its folder spells it, safe in a path pattern."""
    special = "\"#%'*/:=?\\{[]^"
    return as_pattern("".join(f"%{ord(ch):02X}" if ch in special or ord(ch) < 32 or ord(ch) == 127 else ch for ch in value))
