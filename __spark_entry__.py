"""

Bars are made from the whole ``orders`` table, once as Spark columns and once as
the same SQL for DuckDB. ``BASE`` has one bar per order. ``RESTATED`` has one
bar per order as well: finished orders come again at the same time with another
price, the others come later, so that an upsert updates, inserts and keeps rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barlake.functions import archive_name, landed_path, month_bounds, month_of, task_id, to_bars
from barlake.operators import (
    append_bars,
    compact_months,
    create_bar_table,
    create_landing_table,
    land_archives,
    land_raw,
    loaded_months,
    merge_actions,
    merge_into,
    month_exists,
    month_range,
    month_status,
    scan_landed,
)
from barlake.operators.table import table_location
from barlake.plans import (
    append_if_missing,
    backfill_plan,
    backfill_run,
    load_month,
    load_raw,
    load_units,
    missing_months,
    not_landed,
)
from barlake.schema import BAR_COLUMNS, BUCKET_COLUMN, MONTH_COLUMN, RAW_COLUMNS, UNIT_COLUMNS
from barlake.session import shared_dir
from barlake.sources import (
    file_manifest,
    landed_units,
    quarantine_bars,
    read_symbols,
    scan_bars_csv,
    scan_named_files,
    units_exist,
    unzip_bars,
)
from barlake.streaming import pick_up_landed

# The one place that does without the training-data operators where they are not installed.
try:
    import barlake.llm.queries as llm_queries
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("barlake.llm", "corpus_pipeline")):
        raise
    llm_queries = corpus_pipeline = None

# --------------------------------------------------------------------------
# Fixture, one text for both engines. {epoch} is the order date as a number, {shift}
# what RESTATED adds to it, {minute} one minute less a tick.
#
# Times count milliseconds where the queries are about the raw format. The
# upserts count microseconds: with the order key as offset they stay unique up
# to 86.4 billion orders instead of 86.4 million.

_BARS = """
    SELECT {epoch} + {shift} + o_orderkey        AS open_time_ms,
           o_totalprice                          AS open,
           o_totalprice * 2                      AS high,
           o_totalprice / 2                      AS low,
           o_totalprice + {raise}                AS close,
           cast(o_custkey AS double)             AS volume,
           {epoch} + {shift} + o_orderkey + {minute} AS close_time_ms,
           o_totalprice * o_custkey              AS quote_asset_volume,
           o_orderkey                            AS trades,
           o_custkey / 2.0e0                     AS taker_buy_base,
           o_totalprice * o_custkey / 2.0e0      AS taker_buy_quote,
           '0'                                   AS ignore,
           concat('SYM', substr(o_orderpriority, 1, 1)) AS symbol
    FROM orders
"""

# One bar per symbol and day, so that all symbols have bars at the same times.
_DAILY = """
    SELECT {epoch}                        AS open_time_ms,
           min(o_totalprice)              AS open,
           max(o_totalprice)              AS high,
           min(o_totalprice) / 2          AS low,
           max(o_totalprice) / 2          AS close,
           cast(count(*) AS double)       AS volume,
           {epoch} + 86399999             AS close_time_ms,
           cast(max(o_custkey) AS double) AS quote_asset_volume,
           count(*)                       AS trades,
           cast(min(o_custkey) AS double) AS taker_buy_base,
           max(o_custkey) / 2.0e0         AS taker_buy_quote,
           '0'                            AS ignore,
           concat('SYM', substr(o_orderpriority, 1, 1)) AS symbol
    FROM orders GROUP BY o_orderdate, concat('SYM', substr(o_orderpriority, 1, 1))
"""

_EPOCH = {
    # Order dates have no time of day. Day numbers do not depend on the session's time zone.
    "spark": {
        "ms": "unix_date(cast(o_orderdate AS date)) * 86400000L",
        "us": "unix_date(cast(o_orderdate AS date)) * 86400000000L",
    },
    "duckdb": {"ms": "epoch_ms(o_orderdate)", "us": "epoch_us(o_orderdate)"},
}
_TICKS_PER_DAY = {"ms": 86_400_000, "us": 86_400_000_000}
_MONTH = ("1997", "03")
_SYMBOL = "SYM1"
_BY_SYMBOL = ["symbol", "event_time"]
_SYMBOL_BUCKETS = 4


def _bars_sql(engine: str, unit: str, later_days: int = 0) -> str:
    ticks = _TICKS_PER_DAY[unit]
    shift = f"CASE WHEN o_orderstatus = 'F' THEN 0 ELSE {later_days * ticks} END" if later_days else "0"
    return _BARS.format(
        epoch=_EPOCH[engine][unit],
        shift=shift,
        minute=ticks // 1440 - 1,
        **{"raise": "1000.25e0" if later_days else "0.25e0"},
    )


# A later bar comes 40 days later, next to loaded months, or 20 months later,
# half of it past the last loaded month.
_NEAR, _FAR = 40, 608


def _rows_of(spark: SparkSession, sf_dir: str, sql: str, unit: str) -> DataFrame:
    """Raw rows with unit columns."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    rows = spark.sql(sql.replace("FROM orders", "FROM {orders}"), orders=orders)
    day = F.date_from_unix_date(F.floor(F.col("open_time_ms") / _TICKS_PER_DAY[unit]).cast("int"))
    return rows.withColumns({"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM")})


def _raw(spark: SparkSession, sf_dir: str, unit: str = "ms", later_days: int = 0) -> DataFrame:
    return _rows_of(spark, sf_dir, _bars_sql("spark", unit, later_days), unit)


def _bars(spark: SparkSession, sf_dir: str, unit: str = "us", later_days: int = 0) -> DataFrame:
    return to_bars(_raw(spark, sf_dir, unit, later_days), unit)


def _units(raw: DataFrame) -> DataFrame:
    return raw.select(*UNIT_COLUMNS).distinct()


def _ntz(column: str = "event_time") -> Column:
    """The UTC time, in any session time zone."""
    seconds = F.unix_micros(column).cast("decimal(20,0)") / 1_000_000
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).alias(column)


def _text(column: str) -> Column:
    return F.col(column).cast("string").alias(column)


def _table_rows(spark: SparkSession, table: str, *extra) -> DataFrame:
    return spark.table(table).select(*BAR_COLUMNS[:-1], _ntz(), *extra)


def _new_name(spark: SparkSession, kind: str) -> tuple[str, str]:
    location = shared_dir(spark, kind)
    return f"barlake_queries.{location.rpartition('/')[2].replace('-', '_')}", location


def _new_table(spark: SparkSession, with_symbol: bool = False, symbol_buckets: int = 0) -> str:
    table, location = _new_name(spark, "bars")
    create_bar_table(spark, table, location, with_symbol, symbol_buckets)
    return table


def _new_landing(spark: SparkSession) -> tuple[str, str]:
    landing, location = _new_name(spark, "landing")
    create_landing_table(spark, landing, location)
    return landing, location


def _landed(spark: SparkSession, sf_dir: str, unit: str, later_days: int = 0) -> str:
    landing, _ = _new_landing(spark)
    land_raw(spark, landing, _raw(spark, sf_dir, unit, later_days))
    return landing


def _loaded(
    spark: SparkSession, sf_dir: str, unit: str = "us", with_symbol: bool = False, symbol_buckets: int = 0
) -> str:
    table = _new_table(spark, with_symbol, symbol_buckets)
    append_bars(spark, table, _bars(spark, sf_dir, unit))
    return table


# --------------------------------------------------------------------------
# Scans


def scan_kline_csv(spark, sf_dir):
    path = shared_dir(spark, "csv")
    _raw(spark, sf_dir).select(*RAW_COLUMNS).write.csv(path)
    return scan_bars_csv(spark, path)


def scan_work_unit(spark, sf_dir):
    landing = _landed(spark, sf_dir, "ms")
    unit = spark.createDataFrame([(_SYMBOL, *_MONTH)], ", ".join(f"{c} string" for c in UNIT_COLUMNS))
    return scan_landed(spark, landing, unit)


def table_scan(spark, sf_dir):
    return _table_rows(spark, _loaded(spark, sf_dir))


def raw_manifest(spark, sf_dir):
    return landed_units(spark, _landed(spark, sf_dir, "ms"))


def raw_exists(spark, sf_dir):
    landing = _landed(spark, sf_dir, "ms")
    return units_exist(_units(_raw(spark, sf_dir, "ms", _FAR)), landed_units(spark, landing))


def unzip_klines(spark, sf_dir):
    def zip_batches(batches):
        """A ZIP archive of the rows of each batch, as a file source would deliver it."""
        import io
        import zipfile

        import pyarrow as pa
        from pyarrow import csv

        plain = csv.WriteOptions(include_header=False)
        for batch in batches:
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive, archive.open("bars.csv", "w") as member:
                csv.write_csv(batch, member, plain)
            yield pa.RecordBatch.from_pylist(
                [{"symbol": "ALL", "year": "0000", "month": "00", "content": out.getvalue()}]
            )

    archives = _raw(spark, sf_dir).select(*RAW_COLUMNS).mapInArrow(
        zip_batches, "symbol string, year string, month string, content binary"
    )
    return unzip_bars(archives).select(*RAW_COLUMNS)


# Twelve fields; some orders have one too many or too few, some a letter for a price, some no time.
_LINES = """
    SELECT concat_ws(',',
               CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE concat(o_orderkey, '') END,
               CASE WHEN o_orderstatus = 'P' THEN 'x' ELSE concat(o_custkey, '') END,
               o_custkey, o_custkey, o_custkey, o_custkey, o_orderkey, o_custkey, o_custkey, o_custkey, o_custkey,
               CASE o_orderstatus WHEN 'O' THEN '0,1' ELSE '0' END) AS text,
           CASE WHEN o_orderstatus = 'O' THEN 'fields' WHEN o_orderstatus = 'P' THEN 'value' END AS reason
    FROM orders WHERE o_orderkey % 11 <> 0 OR o_orderstatus <> 'F'
"""


def scan_kline_rejects(spark, sf_dir):
    path = shared_dir(spark, "lines")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.sql(_LINES.replace("FROM orders", "FROM {orders}"), orders=orders)
    lines.select("text").write.text(path)
    checked = quarantine_bars(spark, path)
    good = checked.good.select(F.col("open_time_ms").cast("string").alias("text"), F.lit("good").alias("reason"))
    return checked.rejects.select("text", "reason").unionAll(good)


def symbol_list(spark, sf_dir):
    """A list file with one entry per order, padded, and comment and blank lines between."""
    path = shared_dir(spark, "symbols")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    line = F.expr("""
        CASE o_orderstatus
            WHEN 'F' THEN concat(' \\t', 'SYM', o_custkey, ' ')
            WHEN 'O' THEN concat(' # SYM', o_custkey)
            ELSE ' \\t' END
    """)
    orders.select(line.alias("value")).write.text(path)
    return read_symbols(spark, path)


# --------------------------------------------------------------------------
# Transform and months


def kline_transform(spark, sf_dir):
    return to_bars(_raw(spark, sf_dir).select(*RAW_COLUMNS)).withColumn("event_time", _ntz())


def source_row_count(spark, sf_dir):
    done = merge_into(spark, _new_table(spark), _bars(spark, sf_dir))
    return spark.range(1).select(F.lit(done.source).cast("bigint").alias("source_rows"))


def month_partitioned_table(spark, sf_dir):
    return _table_rows(spark, _loaded(spark, sf_dir), _text(MONTH_COLUMN))


def sorted_month_files(spark, sf_dir):
    """Per month: rows, and rows stored behind a later row of their file (none)."""
    rows = spark.table(_loaded(spark, sf_dir)).select(
        MONTH_COLUMN, "event_time", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    before = F.lag("event_time").over(Window.partitionBy("file").orderBy("row"))
    marked = rows.withColumn("unsorted", before > F.col("event_time"))
    return marked.groupBy(_text(MONTH_COLUMN)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("unsorted").alias("unsorted")
    )


def month_range_query(spark, sf_dir):
    rows = month_range(spark.table(_loaded(spark, sf_dir)), *_MONTH)
    return rows.select(*BAR_COLUMNS[:-1], _ntz())


def month_exists_query(spark, sf_dir):
    found = month_exists(spark, _loaded(spark, sf_dir), *_MONTH)
    return spark.range(1).select(F.lit("-".join((*_MONTH, "01"))).alias(MONTH_COLUMN), F.lit(found).alias("row_exists"))


def _months_of(bars: DataFrame) -> DataFrame:
    return bars.select(month_of(F.col("event_time")).alias(MONTH_COLUMN)).distinct()


def month_status_query(spark, sf_dir):
    table = _loaded(spark, sf_dir)
    asked = _months_of(_bars(spark, sf_dir, later_days=_FAR))
    return month_status(spark, table, asked).select(_text(MONTH_COLUMN), "status")


def loaded_months_query(spark, sf_dir):
    return loaded_months(spark, _loaded(spark, sf_dir)).select(_text(MONTH_COLUMN))


def month_bounds_query(spark, sf_dir):
    bounds = month_bounds(_units(_raw(spark, sf_dir)))
    return bounds.select(*UNIT_COLUMNS, _text("month_start"), _text("month_end"))


def work_unit_paths(spark, sf_dir):
    units = _units(_raw(spark, sf_dir)).withColumn("month", F.col("month").cast("int"))
    return units.select(
        landed_path("bars").alias("landed"), archive_name().alias("archive"), task_id("load").alias("task")
    )


# --------------------------------------------------------------------------
# Writes


def append_month(spark, sf_dir):
    table = _loaded(spark, sf_dir)
    append_bars(spark, table, _bars(spark, sf_dir, later_days=_NEAR))
    return _table_rows(spark, table)


def append_if_missing_query(spark, sf_dir):
    table = _loaded(spark, sf_dir)
    append_if_missing(spark, _landed(spark, sf_dir, "us", _FAR), table, time_unit="us")
    return _table_rows(spark, table)


def merge_upsert(spark, sf_dir):
    table = _loaded(spark, sf_dir)
    merge_into(spark, table, _bars(spark, sf_dir, later_days=_NEAR))
    return _table_rows(spark, table)


def merge_idempotent(spark, sf_dir):
    table = _loaded(spark, sf_dir)
    for _ in range(2):
        merge_into(spark, table, _bars(spark, sf_dir, later_days=_NEAR))
    return _table_rows(spark, table)


def merge_by_symbol(spark, sf_dir):
    table = _loaded(spark, sf_dir, with_symbol=True)
    merge_into(spark, table, _bars(spark, sf_dir, later_days=_NEAR), ["symbol", "event_time"])
    return _table_rows(spark, table, "symbol")


def merge_in_buckets(spark, sf_dir):
    """The same into a table whose months are parted by symbol."""
    table = _loaded(spark, sf_dir, with_symbol=True, symbol_buckets=_SYMBOL_BUCKETS)
    merge_into(spark, table, _bars(spark, sf_dir, later_days=_NEAR), _BY_SYMBOL)
    return _table_rows(spark, table, "symbol", BUCKET_COLUMN)


def merge_counts(spark, sf_dir):
    """Row counts of a merge, next to the table's row count after it."""
    table = _loaded(spark, sf_dir)
    done = merge_into(spark, table, _bars(spark, sf_dir, later_days=_NEAR))
    return spark.table(table).agg(F.count(F.lit(1)).alias("table_rows")).select(
        "table_rows",
        *(F.lit(getattr(done, c)).cast("bigint").alias(c) for c in ("source", "updated", "inserted", "rejected")),
    )


def merge_row_status(spark, sf_dir):
    columns = BAR_COLUMNS
    target = _bars(spark, sf_dir).select(*columns)
    source = _bars(spark, sf_dir, later_days=_NEAR).select(*columns)
    return merge_actions(target, source).select(_ntz(), F.col("merge_action").alias("status"))


def _landed_rows(spark: SparkSession, landing: str) -> DataFrame:
    return scan_landed(spark, landing).select(*RAW_COLUMNS, *UNIT_COLUMNS)


def land_raw_query(spark, sf_dir):
    return _landed_rows(spark, _landed(spark, sf_dir, "ms"))


def land_skip_existing(spark, sf_dir):
    landing = _landed(spark, sf_dir, "ms")
    land_raw(spark, landing, _raw(spark, sf_dir, "ms", _FAR))
    return _landed_rows(spark, landing)


def land_force(spark, sf_dir):
    landing = _landed(spark, sf_dir, "ms")
    land_raw(spark, landing, _raw(spark, sf_dir, "ms", _FAR), force=True)
    return _landed_rows(spark, landing)


def _archives(spark: SparkSession, sf_dir: str, unit: str, later_days: int = 0) -> str:
    """One ZIP archive per unit, named by it, in the shared folder."""
    root = shared_dir(spark, "archives")

    def write_zip(group):
        import io
        import zipfile

        import pyarrow as pa
        from pyarrow import csv, fs

        symbol, year, month = (group.column(c)[0].as_py() for c in ("symbol", "year", "month"))
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive, archive.open("bars.csv", "w") as member:
            csv.write_csv(group.drop_columns(["symbol", "year", "month"]), member, csv.WriteOptions(include_header=False))
        store, folder = fs.FileSystem.from_uri(root)
        store.create_dir(folder)
        with store.open_output_stream(f"{folder}/{symbol}-1m-{year}-{month}.zip") as file:
            file.write(out.getvalue())
        return pa.table({"n": pa.array([1], pa.int64())})

    rows = _raw(spark, sf_dir, unit, later_days).select(*RAW_COLUMNS, *UNIT_COLUMNS)
    rows.groupBy(*UNIT_COLUMNS).applyInArrow(write_zip, "n bigint").agg(F.sum("n")).collect()
    return root


def land_archives_query(spark, sf_dir):
    landing = _landed(spark, sf_dir, "ms")
    land_archives(spark, landing, _archives(spark, sf_dir, "ms", _FAR))
    return _landed_rows(spark, landing)


def compact_months_query(spark, sf_dir):
    """Three appends, compacted: rows, files and rows stored behind a later row, per month."""
    table = _new_table(spark)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("trades"), "o_orderstatus")
    for status in "FOP":
        rows = _raw(spark, sf_dir, "us").join(orders.filter(F.col("o_orderstatus") == status), "trades", "left_semi")
        append_bars(spark, table, to_bars(rows, "us"))
    compact_months(spark, table)
    rows = spark.table(table).select(
        MONTH_COLUMN, "event_time", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    before = F.lag("event_time").over(Window.partitionBy("file").orderBy("row"))
    return rows.withColumn("unsorted", before > F.col("event_time")).groupBy(_text(MONTH_COLUMN)).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files"), F.count_if("unsorted").alias("unsorted")
    )


# --------------------------------------------------------------------------
# Flows


def load_month_query(spark, sf_dir):
    table = _loaded(spark, sf_dir)
    load_month(spark, _landed(spark, sf_dir, "us", _NEAR), table, _SYMBOL, *_MONTH, time_unit="us")
    return _table_rows(spark, table)


def load_month_in_buckets(spark, sf_dir):
    """Per month and bucket: rows, and files that the load of one symbol and month has put there."""
    table = _loaded(spark, sf_dir, with_symbol=True, symbol_buckets=_SYMBOL_BUCKETS)
    file = F.col("_metadata.file_path").alias("file")
    before = spark.createDataFrame([(f,) for f in spark.table(table).inputFiles()], "file string")
    load_month(spark, _landed(spark, sf_dir, "us"), table, _SYMBOL, *_MONTH, _BY_SYMBOL, time_unit="us")
    rows = spark.table(table).select(_text(MONTH_COLUMN), BUCKET_COLUMN, "symbol", file)
    name = F.substring_index("file", "/", -3)
    rows = rows.withColumn("name", name).join(before.select(name.alias("name"), F.lit(True).alias("old")), "name", "left")
    return rows.groupBy(MONTH_COLUMN, BUCKET_COLUMN).agg(
        F.count(F.lit(1)).alias("n"), F.bool_or(F.col("old").isNull()).alias("rewritten")
    )


def _plan(spark: SparkSession, sf_dir: str, later_days: int = 0) -> DataFrame:
    raw = _raw(spark, sf_dir, "us", later_days)
    span = raw.agg(F.min("open_time_ms"), F.max("open_time_ms")).select(
        *(F.timestamp_micros(F.col(c)).cast("date") for c in ("min(open_time_ms)", "max(open_time_ms)"))
    )
    return backfill_plan(raw, *span.first())


def backfill_plan_query(spark, sf_dir):
    return _plan(spark, sf_dir, _FAR)


def units_to_land(spark, sf_dir):
    return not_landed(spark, _plan(spark, sf_dir, _FAR), _landed(spark, sf_dir, "us"))


def missing_months_query(spark, sf_dir):
    return missing_months(spark, _plan(spark, sf_dir, _FAR), _loaded(spark, sf_dir))


def missing_months_by_symbol(spark, sf_dir):
    table = _loaded(spark, sf_dir, with_symbol=True)
    return missing_months(spark, _plan(spark, sf_dir, _FAR), table, by_symbol=True)


def backfill_run_query(spark, sf_dir):
    table = _loaded(spark, sf_dir, with_symbol=True)
    landing = _landed(spark, sf_dir, "us", _FAR)
    backfill_run(spark, landing, table, _plan(spark, sf_dir, _FAR), keys=["symbol", "event_time"], time_unit="us")
    return _table_rows(spark, table, "symbol")


def backfill_run_archives(spark, sf_dir):
    """From archives to the table in one call."""
    table = _loaded(spark, sf_dir, with_symbol=True)
    landing, _ = _new_landing(spark)
    archives = _archives(spark, sf_dir, "us", _FAR)
    backfill_run(spark, landing, table, _plan(spark, sf_dir, _FAR), archives, _BY_SYMBOL, "us")
    return _table_rows(spark, table, "symbol")


def backfill_first_load(spark, sf_dir):
    """Every unit into an empty table: no join takes place."""
    table = _new_table(spark, with_symbol=True)
    load_units(spark, _landed(spark, sf_dir, "us"), table, keys=["symbol", "event_time"], time_unit="us")
    return _table_rows(spark, table, "symbol")


def load_symbols_by_time(spark, sf_dir):
    """Symbols at the same times with the time as the only key: the last one stays."""
    table = _new_table(spark, with_symbol=True)
    load_raw(spark, table, _rows_of(spark, sf_dir, _DAILY.format(epoch=_EPOCH["spark"]["ms"]), "ms"))
    return _table_rows(spark, table, "symbol")


def stream_pickup(spark, sf_dir):
    """Two waves of landed files and one run without new files, over one checkpoint."""
    table = _new_table(spark, with_symbol=True)
    landing, location = _new_landing(spark)
    checkpoint = shared_dir(spark, "stream")
    waves = [_raw(spark, sf_dir, "us"), None, _raw(spark, sf_dir, "us", _FAR)]
    for wave in waves:
        if wave is not None:
            land_raw(spark, landing, wave)
        pick_up_landed(
            spark, location, table, checkpoint, ["symbol", "event_time"], time_unit="us"
        ).awaitTermination()
    return _table_rows(spark, table, "symbol")


def stream_pickup_small_batches(spark, sf_dir):
    """Symbols at the same times, their files dealt over several batches."""
    table = _new_table(spark, with_symbol=True)
    landing, location = _new_landing(spark)
    land_raw(spark, landing, _rows_of(spark, sf_dir, _DAILY.format(epoch=_EPOCH["spark"]["ms"]), "ms"))
    pick_up_landed(
        spark, location, table, shared_dir(spark, "stream"), ["symbol", "event_time"], max_files=150
    ).awaitTermination()
    return _table_rows(spark, table, "symbol")


def _files(spark: SparkSession):
    """The file system of the shared folder, whatever store it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(shared_dir(spark, "files"))
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _named_files(spark: SparkSession, sf_dir: str) -> str:
    """One file per unit, named by it, in ``year=/month=`` folders."""
    written, root = shared_dir(spark, "written"), shared_dir(spark, "named")
    parts = ["year", "month", "symbol"]
    _raw(spark, sf_dir, "us").repartition(*parts).select(*RAW_COLUMNS, *parts).write.partitionBy(*parts).csv(written)
    system, path = _files(spark)
    for found in system.globStatus(path(f"{written}/year=*/month=*/symbol=*/part-*")):
        year, month, symbol = (p.partition("=")[2] for p in found.getPath().toString().split("/")[-4:-1])
        system.mkdirs(path(f"{root}/year={year}/month={month}"))
        system.rename(found.getPath(), path(f"{root}/year={year}/month={month}/{symbol}-1m-{year}-{month}.csv"))
    return root


def scan_named_files_query(spark, sf_dir):
    return scan_named_files(spark, _named_files(spark, sf_dir))


def named_file_manifest(spark, sf_dir):
    return file_manifest(spark, _named_files(spark, sf_dir)).select(*UNIT_COLUMNS)


def stream_pickup_named_files(spark, sf_dir):
    table = _new_table(spark, with_symbol=True)
    pick_up_landed(
        spark, _named_files(spark, sf_dir), table, shared_dir(spark, "stream"), ["symbol", "event_time"], time_unit="us"
    ).awaitTermination()
    return _table_rows(spark, table, "symbol")


def month_status_after_loss(spark, sf_dir):
    """A month whose folder has lost its files is missing, though the catalog lists it."""
    table = _loaded(spark, sf_dir)
    system, path = _files(spark)
    system.delete(path(f"{table_location(spark, table)}/{MONTH_COLUMN}={'-'.join((*_MONTH, '01'))}"), True)
    return month_status(spark, table, _months_of(_bars(spark, sf_dir))).select(_text(MONTH_COLUMN), "status")


def load_mixed_time_units(spark, sf_dir):
    """Units of two symbols count microseconds, the others milliseconds."""
    table = _new_table(spark, with_symbol=True)
    fine = F.col("symbol").isin("SYM1", "SYM2")
    time = F.when(fine, F.col("open_time_ms") * 1000).otherwise(F.col("open_time_ms"))
    raw = _raw(spark, sf_dir).withColumn("open_time_ms", time)
    load_raw(spark, table, raw, ["symbol", "event_time"], F.when(fine, "us").otherwise("ms"))
    return _table_rows(spark, table, "symbol")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: upsert of restated bars into a loaded month-partitioned table."""
    return merge_upsert(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = _bar_queries()
    if llm_queries:
        named |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return named


def _bar_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_kline_csv": scan_kline_csv,
        "scan_work_unit": scan_work_unit,
        "table_scan": table_scan,
        "raw_manifest": raw_manifest,
        "raw_exists": raw_exists,
        "unzip_klines": unzip_klines,
        "symbol_list": symbol_list,
        "kline_transform": kline_transform,
        "source_row_count": source_row_count,
        "month_partitioned_table": month_partitioned_table,
        "sorted_month_files": sorted_month_files,
        "month_range": month_range_query,
        "month_exists": month_exists_query,
        "month_status": month_status_query,
        "loaded_months": loaded_months_query,
        "month_bounds": month_bounds_query,
        "work_unit_paths": work_unit_paths,
        "append_month": append_month,
        "append_if_missing": append_if_missing_query,
        "merge_upsert": merge_upsert,
        "merge_idempotent": merge_idempotent,
        "merge_by_symbol": merge_by_symbol,
        "merge_in_buckets": merge_in_buckets,
        "merge_counts": merge_counts,
        "merge_row_status": merge_row_status,
        "land_raw": land_raw_query,
        "land_skip_existing": land_skip_existing,
        "land_force": land_force,
        "load_month": load_month_query,
        "load_month_in_buckets": load_month_in_buckets,
        "backfill_plan": backfill_plan_query,
        "units_to_land": units_to_land,
        "missing_months": missing_months_query,
        "missing_months_by_symbol": missing_months_by_symbol,
        "backfill_run": backfill_run_query,
        "backfill_first_load": backfill_first_load,
        "load_symbols_by_time": load_symbols_by_time,
        "stream_pickup": stream_pickup,
        "stream_pickup_small_batches": stream_pickup_small_batches,
        "stream_pickup_named_files": stream_pickup_named_files,
        "scan_named_files": scan_named_files_query,
        "named_file_manifest": named_file_manifest,
        "month_status_after_loss": month_status_after_loss,
        "load_mixed_time_units": load_mixed_time_units,
        "scan_kline_rejects": scan_kline_rejects,
        "land_archives": land_archives_query,
        "backfill_run_archives": backfill_run_archives,
        "compact_months": compact_months_query,
    }


# --------------------------------------------------------------------------
# Oracle SQL

_VALUES = ", ".join(BAR_COLUMNS[:-1])
_RAW_LIST = ", ".join(RAW_COLUMNS)


def _with(unit: str, later_days: int = _NEAR) -> str:
    """CTEs ``k`` (BASE) and ``r`` (RESTATED) with event time, month and unit text."""
    time = "make_timestamp(open_time_ms * 1000)" if unit == "ms" else "make_timestamp(open_time_ms)"
    parts = [
        f"{name} AS (SELECT *, strftime(event_time, '%Y') AS year, strftime(event_time, '%m') AS month, "
        "strftime(event_time, '%Y-%m-01') AS event_month "
        f"FROM (SELECT *, {time} AS event_time FROM ({_bars_sql('duckdb', unit, days)})))"
        for name, days in (("k", 0), ("r", later_days))
    ]
    return "WITH " + ", ".join(parts) + " "


def _merged(keys: list[str], source: str = "r", extra: str = "") -> str:
    match = " AND ".join(f"s.{c} = k.{c}" for c in keys)
    return (
        f"SELECT {_VALUES}, event_time{extra} FROM k WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {match}) "
        f"UNION ALL SELECT {_VALUES}, event_time{extra} FROM {source}"
    )


def oracle_sql() -> dict[str, str]:
    named = _bar_oracle_sql()
    if llm_queries:
        named |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            named["pipeline"] = corpus_pipeline.ORACLE_SQL
    return named


def _bar_oracle_sql() -> dict[str, str]:
    ms, us, ms_far, us_far = _with("ms"), _with("us"), _with("ms", _FAR), _with("us", _FAR)
    year, month = _MONTH
    in_month = f"event_time >= TIMESTAMP '{year}-{month}-01' AND event_time < TIMESTAMP '{year}-{month}-01' + INTERVAL 1 MONTH"
    one_unit = f"symbol = '{_SYMBOL}' AND year = '{year}' AND month = '{month}'"
    by_symbol = ["symbol", "event_time"]
    plan = (
        "p AS (SELECT symbol, strftime(m, '%Y') AS year, strftime(m, '%m') AS month, "
        "strftime(m, '%Y-%m-01') AS event_month FROM (SELECT DISTINCT symbol FROM r), "
        "(SELECT unnest(generate_series((SELECT min(date_trunc('month', event_time)) FROM r), "
        "(SELECT max(date_trunc('month', event_time)) FROM r), INTERVAL 1 MONTH)) AS m)) "
    )
    landed = f"SELECT {_RAW_LIST}, symbol, year, month FROM"
    same_unit = "a.symbol = b.symbol AND a.year = b.year AND a.month = b.month"
    bucket = "CASE symbol " + " ".join(
        f"WHEN 'SYM{i}' THEN {zlib.crc32(f'SYM{i}'.encode()) % _SYMBOL_BUCKETS}" for i in range(10)
    ) + " END"
    own_bucket = zlib.crc32(_SYMBOL.encode()) % _SYMBOL_BUCKETS
    status = """
        SELECT k.event_time, CASE WHEN r.event_time IS NULL THEN 'kept' ELSE 'updated' END AS status
        FROM k LEFT JOIN r ON k.event_time = r.event_time
        UNION ALL SELECT r.event_time, 'inserted' FROM r LEFT JOIN k ON k.event_time = r.event_time
        WHERE k.event_time IS NULL
    """
    return {
        "scan_kline_csv": f"{ms} SELECT {_RAW_LIST} FROM k",
        "scan_work_unit": f"{ms} {landed} k WHERE {one_unit}",
        "table_scan": f"{us} SELECT {_VALUES}, event_time FROM k",
        "raw_manifest": f"{ms} SELECT DISTINCT symbol, year, month FROM k",
        "raw_exists": f"{ms_far} SELECT DISTINCT symbol, year, month, "
        f"EXISTS (SELECT 1 FROM k b WHERE {same_unit}) AS row_exists FROM r a",
        "unzip_klines": f"{ms} SELECT {_RAW_LIST} FROM k",
        "symbol_list": "SELECT concat('SYM', o_custkey) AS symbol FROM orders WHERE o_orderstatus = 'F'",
        "kline_transform": f"{ms} SELECT {_VALUES}, event_time FROM k",
        "source_row_count": "SELECT count(*) AS source_rows FROM orders",
        "month_partitioned_table": f"{us} SELECT {_VALUES}, event_time, event_month FROM k",
        "sorted_month_files": f"{us} SELECT event_month, count(*) AS n, cast(0 AS bigint) AS unsorted "
        "FROM k GROUP BY event_month",
        "month_range": f"{us} SELECT {_VALUES}, event_time FROM k WHERE {in_month}",
        "month_exists": f"{us} SELECT '{year}-{month}-01' AS event_month, "
        f"EXISTS (SELECT 1 FROM k WHERE {in_month}) AS row_exists",
        "month_status": f"{us_far} SELECT DISTINCT event_month, CASE WHEN event_month IN "
        "(SELECT event_month FROM k) THEN 'EXISTS' ELSE 'MISSING' END AS status FROM r",
        "loaded_months": f"{us} SELECT DISTINCT event_month FROM k",
        "month_bounds": f"{ms} SELECT DISTINCT symbol, year, month, event_month AS month_start, "
        "strftime(cast(event_month AS date) + INTERVAL 1 MONTH, '%Y-%m-%d') AS month_end FROM k",
        "work_unit_paths": f"{ms} SELECT DISTINCT "
        "printf('bars/year=%s/month=%s/%s-1m-%s-%s.csv', year, month, symbol, year, month) AS landed, "
        "printf('%s-1m-%s-%s.zip', symbol, year, month) AS archive, "
        "concat('load_', lower(symbol)) AS task FROM k",
        "append_month": f"{us} SELECT {_VALUES}, event_time FROM k UNION ALL SELECT {_VALUES}, event_time FROM r",
        "append_if_missing": f"{us_far} SELECT {_VALUES}, event_time FROM k UNION ALL "
        f"SELECT {_VALUES}, event_time FROM r WHERE event_month NOT IN (SELECT event_month FROM k)",
        "merge_upsert": us + _merged(["event_time"]),
        "merge_idempotent": us + _merged(["event_time"]),
        "merge_by_symbol": us + _merged(by_symbol, extra=", symbol"),
        "merge_in_buckets": f"{us} SELECT *, {bucket} AS symbol_bucket FROM ({_merged(by_symbol, extra=', symbol')})",
        "merge_counts": f"{us}, s AS ({status}) SELECT count(*) AS table_rows, (SELECT count(*) FROM r) AS source, "
        "count(*) FILTER (status = 'updated') AS updated, count(*) FILTER (status = 'inserted') AS inserted, "
        "cast(0 AS bigint) AS rejected FROM s",
        "merge_row_status": us + status,
        "land_raw": f"{ms} {landed} k",
        "land_skip_existing": f"{ms_far} {landed} k UNION ALL {landed} r a "
        f"WHERE NOT EXISTS (SELECT 1 FROM k b WHERE {same_unit})",
        "land_force": f"{ms_far} {landed} r UNION ALL {landed} k a "
        f"WHERE NOT EXISTS (SELECT 1 FROM r b WHERE {same_unit})",
        "load_month": f"{us}, u AS (SELECT * FROM r WHERE {one_unit}) " + _merged(["event_time"], "u"),
        "load_month_in_buckets": f"{us} SELECT event_month, {bucket} AS symbol_bucket, count(*) AS n, "
        f"event_month = '{year}-{month}-01' AND {bucket} = {own_bucket} AS rewritten FROM k GROUP BY ALL",
        "backfill_plan": f"{us_far}, {plan} SELECT symbol, year, month FROM p",
        "units_to_land": f"{us_far}, {plan} SELECT symbol, year, month FROM p a "
        f"WHERE NOT EXISTS (SELECT 1 FROM k b WHERE {same_unit})",
        "missing_months": f"{us_far}, {plan} SELECT symbol, year, month FROM p "
        "WHERE event_month NOT IN (SELECT event_month FROM k)",
        "missing_months_by_symbol": f"{us_far}, {plan} SELECT symbol, year, month FROM p a "
        f"WHERE NOT EXISTS (SELECT 1 FROM k b WHERE {same_unit})",
        "backfill_run": us_far + _merged(by_symbol, extra=", symbol"),
        "backfill_first_load": f"{us} SELECT {_VALUES}, event_time, symbol FROM k",
        "load_symbols_by_time": f"SELECT {_VALUES}, make_timestamp(open_time_ms * 1000) AS event_time, symbol "
        f"FROM ({_DAILY.format(epoch=_EPOCH['duckdb']['ms'])}) "
        "QUALIFY row_number() OVER (PARTITION BY open_time_ms ORDER BY symbol DESC) = 1",
        "stream_pickup": f"{us_far}, u AS (SELECT * FROM r a WHERE NOT EXISTS (SELECT 1 FROM k b WHERE {same_unit})) "
        + _merged(by_symbol, "u", ", symbol"),
        "stream_pickup_small_batches": f"SELECT {_VALUES}, make_timestamp(open_time_ms * 1000) AS event_time, symbol "
        f"FROM ({_DAILY.format(epoch=_EPOCH['duckdb']['ms'])})",
        "stream_pickup_named_files": f"{us} SELECT {_VALUES}, event_time, symbol FROM k",
        "scan_named_files": f"{us} {landed} k",
        "named_file_manifest": f"{us} SELECT DISTINCT symbol, year, month FROM k",
        "month_status_after_loss": f"{us} SELECT DISTINCT event_month, CASE WHEN event_month = '{year}-{month}-01' "
        "THEN 'MISSING' ELSE 'EXISTS' END AS status FROM k",
        "load_mixed_time_units": f"{ms} SELECT {_VALUES}, event_time, symbol FROM k",
        "scan_kline_rejects": "SELECT CASE WHEN reason IS NULL THEN split_part(text, ',', 1) ELSE text END AS text, "
        f"coalesce(reason, 'good') AS reason FROM ({_LINES})",
        "land_archives": f"{ms_far} {landed} k UNION ALL {landed} r a "
        f"WHERE NOT EXISTS (SELECT 1 FROM k b WHERE {same_unit})",
        "backfill_run_archives": us_far + _merged(by_symbol, extra=", symbol"),
        "compact_months": f"{us} SELECT event_month, count(*) AS n, cast(1 AS bigint) AS files, cast(0 AS bigint) AS unsorted "
        "FROM k GROUP BY event_month",
    }
