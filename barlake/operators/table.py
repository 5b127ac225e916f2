"""The month-partitioned bar table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.functions.calendar import month_of
from barlake.schema import BAR_COLUMNS, BUCKET_COLUMN, MONTH_COLUMN, RAW_SCHEMA
from barlake.session import adaptive_enabled, parquet_timestamps

_BUCKETS = "barlake.symbol_buckets"


def ensure_table(
    spark: SparkSession, table: str, columns: str, source: str, partition: str, location: str, buckets: int = 0
) -> bool:
    """Create namespace and table where missing; pick up partitions already on disk. Tells whether it was missing.

    The dynamic overwrite mode is stored with the table, so no overwrite in any
    session can remove partitions it has no rows for.
    """
    if spark.catalog.tableExists(table):
        return False
    location = location.rstrip("/").replace("'", "\\'")
    namespace, dot, _ = table.rpartition(".")
    if dot:
        parent = location.rpartition("/")[0]
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace} LOCATION '{parent}'")
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {table} ({columns})
        USING {source} OPTIONS (partitionOverwriteMode 'dynamic')
        PARTITIONED BY ({partition}) LOCATION '{location}' TBLPROPERTIES ('{_BUCKETS}' = '{buckets}')
    """)
    # Appending nothing makes the folder, which partition recovery requires.
    spark.table(table).limit(0).write.insertInto(table)
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return True


def current(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now.

    A session keeps the file listing of its first read. Files that another
    session has added since would be missing from it, and a rewrite of their
    month would lose them.
    """
    spark.catalog.refreshTable(table)
    return spark.table(table)


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'")
    return described.first()["data_type"].rstrip("/")


def create_bar_table(
    spark: SparkSession, table: str, location: str, with_symbol: bool = False, symbol_buckets: int = 0
) -> None:
    """Bar table partitioned by ``event_month``; ``with_symbol`` for tables of many symbols.

    With ``symbol_buckets`` a month is parted by a hash of the symbol, so that a load of few symbols rewrites their buckets
    and no others. The number is stored with the table. A table registered again at a location needs the number it was made with.
    """
    # Known to both modules: partitions are read and replaced through the table.
    from barlake.operators.partitions import recover_versions

    if symbol_buckets and not with_symbol:
        raise ValueError("buckets of symbols need a table with symbols")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in RAW_SCHEMA.fields if f.name in BAR_COLUMNS]
    symbol = ["symbol STRING"] if with_symbol else []
    bucket = [f"{BUCKET_COLUMN} INT"] if symbol_buckets else []
    columns = ", ".join([*kept, "event_time TIMESTAMP", *symbol, f"{MONTH_COLUMN} DATE", *bucket])
    parts = ", ".join([MONTH_COLUMN, *([BUCKET_COLUMN] if symbol_buckets else [])])
    if ensure_table(spark, table, columns, "parquet", parts, location, symbol_buckets):
        recover_versions(spark, table)


def symbol_buckets(spark: SparkSession, table: str) -> int:
    """The number of buckets a table was made with; 0 for a table without."""
    if BUCKET_COLUMN not in spark.table(table).columns:
        return 0
    return int(spark.sql(f"SHOW TBLPROPERTIES {table} ('{_BUCKETS}')").first()["value"])


def bucket_of(symbol: Column, buckets: int) -> Column:
    """The same in every engine: CRC-32 of the symbol's UTF-8 bytes, modulo the number; no symbol counts as empty."""
    return F.pmod(F.crc32(F.coalesce(symbol, F.lit("")).cast("binary")), F.lit(buckets)).cast("int")


def with_month(bars: DataFrame) -> DataFrame:
    return bars.withColumn(MONTH_COLUMN, month_of(F.col("event_time")))


def with_partitions(bars: DataFrame, buckets: int) -> DataFrame:
    """The columns by which a table with that many buckets is partitioned."""
    rows = with_month(bars)
    return rows.withColumn(BUCKET_COLUMN, bucket_of(F.col("symbol"), buckets)) if buckets else rows


def clustered(df: DataFrame, *columns: str) -> DataFrame:
    """One shuffle that brings rows of a partition together but splits large ones.

    The rebalance hint lets adaptive execution cut a partition that holds far
    more rows than the others into several tasks and join small ones. Without
    adaptive execution a hash of the row's time does the splitting.
    """
    if adaptive_enabled(df.sparkSession):
        return df.hint("rebalance", *columns)
    splits = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    time = "event_time" if "event_time" in df.columns else "open_time_ms"
    return df.repartition(*columns, F.pmod(F.xxhash64(time), F.lit(splits)))


def sorted_by_month(bars: DataFrame) -> DataFrame:
    """Layout of table files: rows of a partition together and in time order."""
    parts = [c for c in (MONTH_COLUMN, BUCKET_COLUMN) if c in bars.columns]
    return clustered(bars, *parts).sortWithinPartitions(*parts, "event_time")


def append_bars(spark: SparkSession, table: str, bars: DataFrame) -> None:
    """Append, matching columns by name."""
    columns = spark.table(table).columns
    rows = sorted_by_month(with_partitions(bars, symbol_buckets(spark, table)).select(*columns))
    with parquet_timestamps(rows.sparkSession):
        rows.write.insertInto(table)
