"""CSV scans of raw bars."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from barlake.schema import RAW_COLUMNS, RAW_SCHEMA, UNIT_COLUMNS
from barlake.session import shared_dir
from barlake.sources.units import has_unit_name, only_units, units_from_name


def scan_bars_csv(spark: SparkSession, path: str | list[str], corrupt_column: str | None = None) -> DataFrame:
    """Headerless bar files with the declared schema, in permissive mode.

    A bad field is NULL, a short row is padded and a long one cut; no row is
    dropped. ``corrupt_column`` adds the text of such rows.
    """
    schema, options = RAW_SCHEMA, {"mode": "PERMISSIVE"}
    if corrupt_column:
        schema = T.StructType([*RAW_SCHEMA.fields, T.StructField(corrupt_column, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt_column
    return spark.read.schema(schema).options(**options).csv(path)


@dataclass(frozen=True)
class CheckedBars:
    """``good`` raw rows, and ``rejects`` with the text of each bad row, its file and the reason."""

    good: DataFrame
    rejects: DataFrame


def quarantine_bars(spark: SparkSession, path: str | list[str]) -> CheckedBars:
    """Raw bars parsed once, with bad rows set apart.

    A row is bad if it has more or fewer fields than the schema (``fields``), else if a field is no value of its type
    (``value``), else if it has no time (``time``), in that order; blank lines are no rows. Where only the time is missing the text is
    made of the row's values. Both parts are stored under ``spark.checkpoint.dir``, left to that folder's clean-up, and
    each is read without the other.
    """
    text, names = "_text", F.col("_metadata.file_path").alias("file")
    parsed = scan_bars_csv(spark, path, text).select(*RAW_COLUMNS, text, names)
    # A comma inside quotes parts no fields.
    fields = F.size(F.split(F.regexp_replace(text, '"[^"]*"', ""), ",", -1))
    reason = (
        F.when(F.col(text).isNotNull() & (fields != len(RAW_COLUMNS)), "fields")
        .when(F.col(text).isNotNull(), "value")
        .when(F.col("open_time_ms").isNull(), "time")
    )
    whole = F.coalesce(text, F.to_csv(F.struct(*RAW_COLUMNS)))
    stored = shared_dir(spark, "checked-bars")
    checked = parsed.select(
        *RAW_COLUMNS, F.when(reason.isNotNull(), whole).alias("text"), "file", reason.alias("reason"), reason.isNotNull().alias("bad")
    )
    checked.write.partitionBy("bad").parquet(stored)
    kept = spark.read.schema(checked.schema).parquet(stored)
    return CheckedBars(
        kept.filter(~F.col("bad")).select(*RAW_COLUMNS), kept.filter("bad").select("text", "file", "reason")
    )


def scan_named_files(spark: SparkSession, root: str, units: DataFrame | None = None) -> DataFrame:
    """Bar files landed by others as ``year=/month=/{symbol}-1m-{yyyy}-{mm}.csv``.

    The symbol exists only in the file name, so it is read from the file
    metadata; a filter on it skips whole files. Files whose name tells no unit are not bars and
    give no rows.
    """
    schema = T.StructType([*RAW_SCHEMA.fields, *(T.StructField(c, T.StringType()) for c in ("year", "month"))])
    symbol = units_from_name(F.col("_metadata.file_name"))[0]
    files = spark.read.schema(schema).csv(root).filter(has_unit_name(F.col("_metadata.file_name")))
    raw = files.withColumn("symbol", symbol)
    if units is not None:
        raw = only_units(raw, units)
    return raw.select(*RAW_COLUMNS, *UNIT_COLUMNS)
