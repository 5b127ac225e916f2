"""Rewriting months that consist of many small files."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from barlake.folders import as_pattern, lengths
from barlake.operators.partitions import Partition, Version, in_partitions, listed_partitions, loaded_partitions, partition_columns
from barlake.operators.table import current, sorted_by_month

#: A month larger than a file is rewritten if it has so many times the files it needs.
_SLACK = 4


def _file_bytes(spark: SparkSession) -> int:
    size = spark._jsparkSession.sessionState().conf().getConfString("spark.sql.files.maxPartitionBytes", "128MB")
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def compact_months(
    spark: SparkSession, table: str, months: Sequence[dt.date | None] | None = None, file_bytes: int | None = None
) -> list[Partition]:
    """Rewrite partitions with many small files, in time order; tells which. Rows do not change.

    Lengths come from the store, no file is opened for the choice. A partition of ``file_bytes`` (by default one input split)
    or less is due if it has several files, and becomes one; a larger one is due if it has four times the files
    it needs, and is cut by adaptive execution. New files take the place of old ones as in an upsert, so a lost driver leaves each partition whole. By default
    all months of the table are asked. Months without files, or that the table does not hold, are passed over.
    """
    target = _file_bytes(spark) if file_bytes is None else file_bytes
    columns = partition_columns(spark, table)
    asked = {p[0] for p in listed_partitions(spark, table)} if months is None else months
    small, large = {}, {}
    for partition, folders in loaded_partitions(spark, table, list(asked)).items():
        sizes = [n for folder in folders for n in lengths(spark, f"{as_pattern(folder)}/[!._]*")]
        if sum(sizes) <= target:
            if len(sizes) > 1:
                small[partition] = folders
        elif len(sizes) >= _SLACK * math.ceil(sum(sizes) / target):
            large[partition] = folders
    if not small and not large:
        return []
    rows = lambda partitions: current(spark, table).filter(in_partitions(partitions, columns))
    with Version(spark, table) as version:
        if small:
            # One file each: such a partition is no larger than an input split.
            version.write(_in_time_order(rows(small).repartition(*columns), columns))
        if large:
            version.write(sorted_by_month(rows(large)))
        version.swap(small | large)
    return sorted(small | large, key=str)


def _in_time_order(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    return rows.sortWithinPartitions(*columns, "event_time")
