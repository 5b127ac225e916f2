"""Symbol list file."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.functions.paths import trim_whitespace

# Fixed value: the symbol used when there is no list.
DEFAULT_SYMBOL = "BTCUSDT"


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """One symbol per line; blank lines and ``#`` lines are skipped, repeats are kept."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(1).select(F.lit(DEFAULT_SYMBOL).alias("symbol"))
    symbols = lines.select(trim_whitespace(F.col("value")).alias("symbol"))
    return symbols.filter((F.col("symbol") != "") & ~F.col("symbol").startswith("#"))
