"""Partitions of a bar table: which hold rows, and how new rows take the place of old ones.

A partition is a month, or in a table with symbol buckets a month and a bucket. New rows of a
partition are written to a folder of their own under ``_versions``. When all are there, the catalog is pointed
to the new folders partition by partition, and only then are the old ones removed: whenever the driver is lost, each
partition has either its old or its new rows. The catalog is the truth; where it has lost an entry, the newest version
that was written to its end counts, then the table's own folder.
"""

from __future__ import annotations

import datetime as dt
import re
import time
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.folders import matching, remove, touch
from barlake.operators.table import current, table_location
from barlake.schema import BUCKET_COLUMN, MONTH_COLUMN
from barlake.session import parquet_timestamps

#: (month, or None for rows without a time), or (month, bucket).
Partition = tuple

_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_VERSIONS = "_versions"
_COMPLETE = "_COMPLETE"


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    columns = spark.table(table).columns
    return [c for c in (MONTH_COLUMN, BUCKET_COLUMN) if c in columns]


def _of_path(path: str, columns: Sequence[str]) -> Partition | None:
    values = [re.search(f"(?:^|/){c}=([^/]+)", path) for c in columns]
    if not all(values):
        return None
    month, *bucket = (v[1] for v in values)
    return (None if month == _NO_VALUE else dt.date.fromisoformat(month), *map(int, bucket))


def _folder_of(partition: Partition, columns: Sequence[str]) -> str:
    return "/".join(f"{c}={_NO_VALUE if v is None else v}" for c, v in zip(columns, partition))


def _spec(partition: Partition, columns: Sequence[str]) -> str:
    text = lambda v: "NULL" if v is None else f"DATE'{v}'" if isinstance(v, dt.date) else str(v)
    return "PARTITION (" + ", ".join(f"{c} = {text(v)}" for c, v in zip(columns, partition)) + ")"


def in_partitions(partitions: Iterable[Partition], columns: Sequence[str]) -> Column:
    """Literal predicate on partition columns, each of which prunes by itself where a join would not."""
    partitions = list(partitions)
    months = sorted({p[0] for p in partitions if p[0] is not None})
    keep = F.col(columns[0]).isin(months)
    if any(p[0] is None for p in partitions):
        keep = keep | F.col(columns[0]).isNull()
    if len(columns) > 1:
        buckets = sorted({p[1] for p in partitions})
        keep = keep & F.col(columns[1]).isin(buckets)
        if len(partitions) < len({p[0] for p in partitions}) * len(buckets):
            name = F.concat_ws(" ", F.coalesce(F.col(columns[0]).cast("string"), F.lit("")), columns[1])
            keep = keep & name.isin([f"{p[0] or ''} {p[1]}" for p in partitions])
    return keep


def listed_partitions(spark: SparkSession, table: str) -> set[Partition]:
    columns = partition_columns(spark, table)
    return {_of_path(row[0], columns) for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def _folders(spark: SparkSession, table: str, where: Column) -> dict[Partition, set[str]]:
    """Folders with files of the partitions that the catalog has; no file is opened."""
    columns = partition_columns(spark, table)
    found: dict[Partition, set[str]] = {}
    for file in current(spark, table).filter(where).inputFiles():
        found.setdefault(_of_path(file, columns), set()).add(file.rpartition("/")[0])
    return found


def _register(spark: SparkSession, table: str, folders: dict[Partition, str], columns: Sequence[str]) -> None:
    if folders:
        entries = " ".join(f"{_spec(p, columns)} LOCATION '{_quoted(f)}'" for p, f in folders.items())
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {entries}")


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _unlisted(spark: SparkSession, table: str, months: Sequence[dt.date | None] | None, listed: set[Partition]) -> dict:
    """Folders of partitions that the catalog does not list: the newest complete version, else the table's own."""
    columns, location = partition_columns(spark, table), table_location(spark, table)
    names = "*" if months is None else "{" + ",".join(_NO_VALUE if m is None else str(m) for m in months) + "}"
    inside = f"{columns[0]}={names}" + "".join(f"/{c}=*" for c in columns[1:])
    complete = [x.rpartition("/")[0] for x in matching(spark, f"{location}/{_VERSIONS}/*/{_COMPLETE}")]
    found = {}
    for root in [location, *sorted(complete)]:
        for folder in matching(spark, f"{root}/{inside}"):
            partition = _of_path(folder, columns)
            if partition not in listed and matching(spark, f"{folder}/[!._]*"):
                found[partition] = folder
    return found


def loaded_partitions(
    spark: SparkSession, table: str, months: Sequence[dt.date | None]
) -> dict[Partition, set[str]]:
    """Partitions of ``months`` that hold files, and their folders. Status, plan, append and merge all ask here.

    The catalog alone is no proof: files can be gone from a partition that is listed, and a driver lost
    during a write can leave files that are not. Those are registered, as nothing would read them otherwise.
    """
    columns, months = partition_columns(spark, table), list(dict.fromkeys(months))
    if not months:
        return {}
    where = in_partitions([(m,) for m in months], columns[:1])
    listed = listed_partitions(spark, table)
    unknown = months if len(columns) > 1 else [m for m in months if (m,) not in listed]
    if unknown and (found := _unlisted(spark, table, unknown, listed)):
        _register(spark, table, found, columns)
    return _folders(spark, table, where)


def recover_versions(spark: SparkSession, table: str) -> None:
    """Point a newly made catalog entry to the newest complete version of each partition."""
    columns = partition_columns(spark, table)
    location = table_location(spark, table)
    if matching(spark, f"{location}/{_VERSIONS}/*/{_COMPLETE}"):
        found = _unlisted(spark, table, None, set())
        listed = listed_partitions(spark, table)
        _register(spark, table, {p: f for p, f in found.items() if p not in listed}, columns)
        for partition in found.keys() & listed:
            if f"/{_VERSIONS}/" in found[partition]:
                _point(spark, table, partition, columns, found[partition])


def _point(spark: SparkSession, table: str, partition: Partition, columns: Sequence[str], folder: str) -> None:
    spark.sql(f"ALTER TABLE {table} {_spec(partition, columns)} SET LOCATION '{_quoted(folder)}'")


class Version:
    """New rows of some partitions, in a folder of their own until ``swap`` puts them in place."""

    def __init__(self, spark: SparkSession, table: str):
        self._spark, self._table = spark, table
        self._columns = partition_columns(spark, table)
        self._complete = False
        # By time, so that the newest is known without a catalog.
        self._path = f"{table_location(spark, table)}/{_VERSIONS}/{time.time_ns():020d}-{uuid.uuid4().hex}"

    def __enter__(self) -> Version:
        return self

    def __exit__(self, *_) -> None:
        # Once it is complete, partitions may already be read from it.
        if not self._complete:
            remove(self._spark, self._path)

    def write(self, rows: DataFrame) -> None:
        with parquet_timestamps(self._spark):
            rows.write.mode("append").partitionBy(*self._columns).parquet(self._path)

    def swap(self, old: dict[Partition, set[str]]) -> None:
        """``old``: partitions whose rows have been rewritten, with their folders. One left without rows is dropped."""
        spark, table, columns = self._spark, self._table, self._columns
        self._complete = True
        touch(spark, f"{self._path}/{_COMPLETE}")
        inside = "/".join(f"{c}=*" for c in columns)
        new = {_of_path(f, columns): f for f in matching(spark, f"{self._path}/{inside}")}
        listed = listed_partitions(spark, table)
        _register(spark, table, {p: f for p, f in new.items() if p not in listed}, columns)
        for partition in sorted(new.keys() & listed, key=str):
            _point(spark, table, partition, columns, new[partition])
        for partition in old.keys() - new.keys():
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_spec(partition, columns)}")
        spark.catalog.refreshTable(table)
        for folder in set().union(*old.values()):
            remove(spark, folder)
