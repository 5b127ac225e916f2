"""Folders of whatever store a path names, through Spark's own file system layer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern; the store lists each folder on the way once."""
    system, path = _system(spark, pattern)
    return [status.getPath().toString() for status in system.globStatus(path) or ()]


def as_pattern(path: str) -> str:
    """A path as a pattern that matches it alone."""
    return "".join(f"\\{ch}" if ch in "{},*?[]\\" else ch for ch in path)


def touch(spark: SparkSession, path: str) -> None:
    system, path = _system(spark, path)
    system.create(path, True).close()


def remove(spark: SparkSession, path: str) -> None:
    system, path = _system(spark, path)
    system.delete(path, True)


def lengths(spark: SparkSession, pattern: str) -> list[int]:
    """Bytes of each file that a pattern matches."""
    system, path = _system(spark, pattern)
    return [status.getLen() for status in system.globStatus(path) or () if status.isFile()]
