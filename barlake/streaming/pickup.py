"""Incremental pick-up of landed files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from barlake.folders import matching, remove
from barlake.functions.bars import to_bars
from barlake.functions.calendar import month_of
from barlake.operators.landing import escaped
from barlake.operators.upsert import DEFAULT_KEYS, MergeResult, merge_into
from barlake.schema import MONTH_COLUMN, RAW_SCHEMA, UNIT_COLUMNS, UNIT_SCHEMA
from barlake.session import Stage, parquet_timestamps
from barlake.sources.units import unit_label, units_from_name

_UNIT_LABEL = "unit_label"

# Files of any age are due: by default the source passes over files a week older than the newest.
_ANY_AGE = "36500d"


_BATCH, _LEVEL = "batch", "level"
#: So many folders of one level of the ledger are merged into one of the next.
_FAN_IN = 8


class _Ledger:
    """Units of the keys that another unit may still meet, by batch.

    With the symbol in the key a row in the month of its unit can only be met by a row that lies outside the month of its own
    unit, so these strays alone are kept: of a clean landing nothing. Without the symbol any key can be met and all are
    kept. Batches are merged in levels, each key with its last unit, so the number of folders grows with the logarithm of the
    batches. An entry that is there twice, as after a lost driver, does no harm.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], number: int):
        self._spark, self._path, self._keys, self._number = spark, path, list(keys), number
        self._schema: T.StructType | None = None

    def _folders(self) -> dict[int, list[tuple[int, str]]]:
        """By level: batches before this one. A batch that is run again does not read what it wrote."""
        found: dict[int, list[tuple[int, str]]] = {}
        for folder in matching(self._spark, f"{self._path}/{_LEVEL}=*/{_BATCH}=*"):
            level, batch = (int(part.partition("=")[2]) for part in folder.split("/")[-2:])
            if batch < self._number:
                found.setdefault(level, []).append((batch, folder))
        return found

    def _read(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        return self._spark.read.schema(schema).option("basePath", self._path).parquet(*folders)

    def _write(self, entries: DataFrame, level: int, batch: int) -> None:
        last = entries.groupBy(*self._keys, MONTH_COLUMN).agg(F.max(_UNIT_LABEL).alias(_UNIT_LABEL))
        with parquet_timestamps(self._spark):
            last.write.mode("overwrite").partitionBy(MONTH_COLUMN).parquet(f"{self._path}/{_LEVEL}={level}/{_BATCH}={batch}")

    def latest(self, months: Sequence[str], schema: T.StructType) -> DataFrame | None:
        """The last unit of each key kept by earlier batches, or None if there are none."""
        folders = [folder for level in self._folders().values() for _, folder in level]
        if not folders:
            return None
        kept = self._read(folders, schema).filter(F.col(MONTH_COLUMN).isin(list(months)))
        return kept.groupBy(*self._keys).agg(F.max(_UNIT_LABEL).alias("latest"))

    def add(self, entries: DataFrame) -> None:
        self._schema = entries.schema
        self._write(entries, 0, self._number)

    def merge_levels(self) -> None:
        """To be called when nothing reads the ledger any more."""
        if self._schema is None:
            return
        for level, folders in sorted(self._folders().items()):
            if len(folders) >= _FAN_IN:
                paths = [folder for _, folder in folders]
                self._write(self._read(paths, self._schema), level + 1, max(folders)[0])
                for path in paths:
                    remove(self._spark, path)


def _of_units(spark: SparkSession, location: str, units: Sequence[tuple[str, str, str]], time_unit: str | Column) -> DataFrame | None:
    """Bars of the units that are landed, or None if none is."""
    patterns = [
        (f"{location}/symbol={escaped(s)}/year={y}/month={m}", f"{location}/year={y}/month={m}/{escaped(s)}-1m-{y}-{m}.csv")
        for s, y, m in units
    ]
    paths = [path for pair in patterns for pattern in pair for path in matching(spark, pattern)]
    if not paths:
        return None
    files = spark.read.schema(_FILE_SCHEMA).option("basePath", location).csv(paths)
    return to_bars(_with_units(files), time_unit)


def _due(
    spark: SparkSession, stage: Stage, ledger: _Ledger, batch: DataFrame, keys: Sequence[str], landed: Callable
) -> DataFrame:
    """Rows of a batch whose keys no later unit has, in an earlier batch or in a file that is landed."""
    held = F.year("event_time").between(1, 9999)  # the merge keeps others out
    month = F.when(held, F.date_format(month_of(F.col("event_time")), "yyyy-MM")).alias(MONTH_COLUMN)
    rows = stage.store(batch.select("*", month))
    unit_month = F.substring(_UNIT_LABEL, 1, 7)
    by_symbol = "symbol" in keys
    stray = (F.col(MONTH_COLUMN) != unit_month) if by_symbol else F.lit(True)
    own = rows.filter(stray).select(*keys, _UNIT_LABEL, MONTH_COLUMN).na.drop()
    months = [r[0] for r in rows.select(MONTH_COLUMN).na.drop().distinct().collect()]
    strays = [tuple(r) for r in own.select("symbol", MONTH_COLUMN, unit_month).distinct().collect()] if by_symbol else []
    due = rows
    if (latest := ledger.latest(months, own.schema)) is not None:
        joined = due.join(latest, list(keys), "left")
        due = joined.filter(F.col("latest").isNull() | (F.col(_UNIT_LABEL) >= F.col("latest"))).drop("latest")
    # A stray of an earlier unit gives way to the unit of its month, whether that is loaded already or still to be.
    homes = {(symbol, *month.split("-")) for symbol, month, unit in strays if unit < month}
    if homes and (home := landed(sorted(homes))) is not None:
        in_month = F.date_format(month_of(F.col("event_time")), "yyyy-MM") == unit_month
        beaten = home.withColumn(_UNIT_LABEL, unit_label()).filter(held & in_month).select(*keys, F.lit(True).alias("beaten"))
        joined = due.join(stage.store(beaten.distinct()), list(keys), "left")
        early = F.coalesce(unit_month < F.col(MONTH_COLUMN), F.lit(False))
        due = joined.filter(F.col("beaten").isNull() | ~early).drop("beaten")
    if strays or (not by_symbol and months):
        ledger.add(own)
    return due.drop(MONTH_COLUMN)


_FILE_SCHEMA = T.StructType([*RAW_SCHEMA.fields, *UNIT_SCHEMA.fields])


def _with_units(files: DataFrame) -> DataFrame:
    """Unit columns from the folders, or from the file's name."""
    named = units_from_name(F.col("_metadata.file_name"))
    error = F.raise_error(F.concat(F.lit("no unit in the path of "), F.col("_metadata.file_path"))).cast("string")
    return files.withColumns({c: F.coalesce(c, F.nullif(n, F.lit("")), error) for c, n in zip(UNIT_COLUMNS, named)})


def pick_up_landed(
    spark: SparkSession,
    location: str,
    table: str,
    checkpoint: str,
    keys: Sequence[str] = DEFAULT_KEYS,
    max_files: int = 10_000,
    time_unit: str | Column = "ms",
    report: Callable[[int, MergeResult], None] | None = None,
) -> StreamingQuery:
    """Upsert the files of a landing folder that no earlier run has seen, then stop.

    ``location`` holds the files of a landing table, or files named by their unit in
    ``year=/month=`` folders; the symbol then comes from the name. A file that names no
    unit either way is an error.

    The result does not depend on ``max_files``, which cuts the work: of units that share a key the last by month,
    then symbol, gives the values, whichever batch or run reads it. For that the units of keys that another
    unit may still meet are kept in ``unit_ledger`` under ``checkpoint``: with the symbol among the keys those of rows outside the
    month of their unit, without it those of all. A table that stores the symbol is refused without the symbol among the keys.

    The checkpoint remembers files by path, so a unit rewritten under the same
    file name is not seen; load forced units with ``load_units``. A batch run
    again after a failure upserts the same rows, which changes nothing as long
    as a key occurs once in it. ``report`` gets the number and the result of each
    batch, with the rows kept out of it.
    """
    if "symbol" in spark.table(table).columns and "symbol" not in keys:
        raise ValueError("keys of a table of many symbols must include the symbol")
    files = spark.readStream.schema(_FILE_SCHEMA).option("maxFilesPerTrigger", max_files).option("maxFileAge", _ANY_AGE)
    location = location.rstrip("/")
    bars = to_bars(_with_units(files.csv(location)).withColumn(_UNIT_LABEL, unit_label()), time_unit)
    landed = lambda units: _of_units(spark, location, units, time_unit)

    def upsert(batch: DataFrame, number: int) -> None:
        # The caller's session, not the stream's copy of it: its view of the table
        # stays current, and it has adaptive execution, which a stream turns off.
        with Stage(spark) as stage:
            ledger = _Ledger(spark, f"{checkpoint.rstrip('/')}/unit_ledger", keys, number)
            due = _due(spark, stage, ledger, batch, keys, landed)
            done = merge_into(spark, table, due, keys, unit=_UNIT_LABEL)
            ledger.merge_levels()
        if report is not None:
            report(number, done)

    return (
        bars.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(upsert)
        .start()
    )
