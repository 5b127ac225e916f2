"""What the library needs to know about the caller's session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def _shared_root(spark: SparkSession) -> str:
    """Folder for intermediate data, from ``spark.checkpoint.dir``.

    Executors on other machines must see what is written here. A machine-local
    folder is used only in local mode, where driver and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="barlake-")
    return f"{root.rstrip('/')}/barlake"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{_shared_root(spark)}/{name}-{uuid.uuid4().hex}"


class Stage:
    """Rows stored in the shared folder while a ``with`` block runs.

    A stored copy is computed once, gives every read the same rows, and does not
    have to be computed again when executors are lost. Copies are managed tables
    of a namespace in that folder, so dropping them removes their files. Each stage has a namespace
    of its own: a persistent catalog would keep the folder of the session that made a shared one.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._namespace = f"barlake_stage_{uuid.uuid4().hex}"
        self._tables: list[str] = []

    def __enter__(self) -> Stage:
        location = _shared_root(self._spark).replace("'", "\\'")
        self._spark.sql(f"CREATE NAMESPACE {self._namespace} LOCATION '{location}/{self._namespace}'")
        return self

    def store(self, rows: DataFrame, buckets: int = 0, by: str = "") -> DataFrame:
        """``buckets`` over the values of ``by``: a later join or grouping on that column reads rows where they lie."""
        table = f"{self._namespace}.rows_{uuid.uuid4().hex}"
        self._tables.append(table)
        writer = rows.write.bucketBy(buckets, by) if buckets else rows.write
        with parquet_timestamps(rows.sparkSession):
            writer.saveAsTable(table, format="parquet")
        return self._spark.table(table)

    def __exit__(self, *_) -> None:
        for table in self._tables:
            self._spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._spark.sql(f"DROP NAMESPACE IF EXISTS {self._namespace}")


def adaptive_enabled(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"


@contextmanager
def parquet_timestamps(spark: SparkSession) -> Iterator[None]:
    """Write timestamps as 64-bit microseconds.

    Spark's default, INT96, takes half as much again and stores no minimum and
    maximum, so that a time filter could not skip row groups. There is no write
    option for it, only this setting.
    """
    key = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    spark.conf.set(key, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(key, before)
