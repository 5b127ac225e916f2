"""Intermediate results in the shared folder that the session names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.session import shared_dir


def stored(rows: DataFrame, name: str, *partitions: str) -> DataFrame:
    """Write rows once and read them again.

    Later steps then neither repeat the work nor depend on executors that
    held it. The folder belongs to ``spark.checkpoint.dir``, whose owner cleans it.
    """
    spark = rows.sparkSession
    path = shared_dir(spark, name)
    writer = rows.write.option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
