"""ZIP archives of bar files."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.schema import RAW_COLUMNS, RAW_SCHEMA, UNIT_COLUMNS
from barlake.sources.manifest import file_manifest
from barlake.sources.units import has_unit_name, only_units, units_from_name

# Send the functions below to executors as code, so that these need no copy of
# the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BLOCK_CHARS = 1 << 20
_BLOCK_SCHEMA = "symbol string, year string, month string, block string"


def archive_manifest(spark: SparkSession, root: str) -> DataFrame:
    return file_manifest(spark, root, "*.zip")


def read_archives(spark: SparkSession, root: str, units: DataFrame | None = None) -> DataFrame:
    """Unit columns and ``content`` of archives named after their unit.

    The unit comes from the file metadata, so bodies of other units are not read.
    """
    name = F.col("_metadata.file_name")
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .load(root)
        .filter(has_unit_name(name))
        .select("content", *units_from_name(name))
    )
    if units is not None:
        files = only_units(files, units)
    return files.select(*UNIT_COLUMNS, "content")


def _csv_blocks(content: bytes, label: str) -> Iterator[str]:
    """Blocks of whole lines of the first top-level CSV member, decompressed as a stream."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        member = next((n for n in archive.namelist() if n.endswith(".csv") and "/" not in n), None)
        if member is None:
            raise ValueError(f"no CSV in archive {label}")
        with archive.open(member) as raw:
            text = io.TextIOWrapper(raw, encoding="utf-8-sig", errors="replace")
            while lines := text.readlines(_BLOCK_CHARS):
                yield "".join(lines)


def _unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(name, pa.string()) for name in (*UNIT_COLUMNS, "block")])
    for batch in batches:
        for row in range(batch.num_rows):
            unit = [batch.column(c)[row].as_py() for c in UNIT_COLUMNS]
            content = batch.column("content")[row].as_py()
            for block in _csv_blocks(content, "-".join(map(str, unit))):
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*unit, block)))], schema=schema)


def unzip_lines(archives: DataFrame) -> DataFrame:
    """Non-blank text lines (``value``) of each archive.

    Python only inflates, a block at a time; splitting into lines and all later
    work is in the JVM. An archive is read by one task because deflate cannot
    be split.
    """
    blocks = archives.select(*UNIT_COLUMNS, "content").mapInArrow(_unzip, _BLOCK_SCHEMA)
    lines = blocks.select(*UNIT_COLUMNS, F.explode(F.split("block", "\n")).alias("value"))
    return lines.filter(F.col("value").rlike(r"[^\x00-\x20]"))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Text lines to raw bar columns, with the parser and mode of the file scan."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in RAW_SCHEMA.fields)
    bar = F.from_csv("value", ddl, {"mode": "PERMISSIVE"})
    return lines.select(*UNIT_COLUMNS, bar.alias("bar")).select(
        *(F.col("bar").getField(c).alias(c) for c in RAW_COLUMNS), *UNIT_COLUMNS
    )


def unzip_bars(archives: DataFrame) -> DataFrame:
    return parse_lines(unzip_lines(archives))
