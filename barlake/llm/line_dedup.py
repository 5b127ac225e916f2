"""Line dedup over levelled sorted runs.

Documents come in batches of ascending doc_id. Known line hashes are kept in runs:
tables bucketed and sorted by hash, one new run a batch. A batch reduces its
lines to distinct hashes, is shuffled once into the runs' buckets, merge-joins every run
there without moving it, and what no run knows (the anti join) becomes the new run.
When a level has ``fan_in`` runs they are compacted into one run of the next level, so that
a batch never meets more than ``fan_in - 1`` runs a level.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.session import shared_dir

from .storage import shuffle_partitions, stored

_STRIPPED = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_STRIPPED)), _UPPER, _LOWER)


def _text_id() -> Column:
    """Rows that share a doc_id but not the text are told apart by this."""
    return F.xxhash64(F.lit("row"), F.col("text"))


class LineRuns:
    """Distinct line hashes with the smallest document that holds each, in levelled runs.

    ``add`` takes the lines of a batch (doc_id, h1, h2), whose doc_ids are above those of
    earlier batches, and returns the hashes found more than once so far:
    h1, h2 and ``holder``, the smallest doc_id.

    Bucketing needs tables: runs are tables named ``line_run_…`` of the session's current database,
    with their files in the shared folder. Results read them, so they are left to the caller to drop.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, fan_in: int = 3):
        self._spark = spark
        self._buckets = buckets or shuffle_partitions(spark)
        self._fan_in = fan_in
        self._levels: list[list[DataFrame]] = [[]]

    def _write(self, rows: DataFrame, *partitions: str) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.repartition(self._buckets, *_HASH).write.bucketBy(self._buckets, *_HASH).sortBy(*_HASH)
        writer = writer.partitionBy(*partitions) if partitions else writer
        writer.option("path", shared_dir(self._spark, name)).saveAsTable(name, format="parquet")
        return self._spark.table(name)

    @property
    def runs(self) -> list[DataFrame]:
        return [run for level in self._levels for run in level]

    def add(self, lines: DataFrame) -> DataFrame:
        keys = lines.groupBy(*_HASH).agg(
            F.min("doc_id").alias("holder"), (F.min("doc_id") != F.max("doc_id")).alias("repeated")
        )
        known: Column = F.lit(None).cast("bigint")
        for i, run in enumerate(self.runs):
            old = run.select(*_HASH, F.col("holder").alias(f"holder_{i}"))
            keys = keys.join(old.hint("merge"), _HASH, "left")
            known = F.coalesce(known, F.col(f"holder_{i}"))
        merged = self._write(
            keys.select(
                *_HASH,
                F.coalesce(known, "holder").alias("holder"),
                (F.col("repeated") | known.isNotNull()).alias("repeated"),
                known.isNull().alias("unknown"),
            ),
            "unknown",
        )
        self._levels[0].append(merged.filter("unknown").select(*_HASH, "holder"))
        self._compact()
        return merged.filter("repeated").select(*_HASH, "holder")

    def _compact(self) -> None:
        for level, runs in enumerate(self._levels):
            if len(runs) >= self._fan_in:
                whole = runs[0]
                for run in runs[1:]:
                    whole = whole.unionAll(run)
                if level + 1 == len(self._levels):
                    self._levels.append([])
                self._levels[level + 1].append(self._write(whole))
                self._levels[level] = []


def _batch_bounds(lines: DataFrame, batches: int) -> list[int]:
    return lines.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []


def _marked(docs: DataFrame, min_chars: int, batches: int, fan_in: int, buckets: int | None) -> DataFrame:
    """``row`` with all columns of docs, ``lines``, and ``dropped``, the sorted places of dropped lines."""
    spark = docs.sparkSession
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), _text_id().alias("tid"), "text"
    )
    named = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL").drop("row")
    bounds = _batch_bounds(named, batches)
    batch = F.lit(0)
    for bound in sorted(set(bounds)):
        batch = batch + (F.col("doc_id") > F.lit(int(bound))).cast("int")
    keys = named.select("doc_id", "tid", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keys = keys.select("doc_id", "tid", "pos", line_key(F.col("line")).alias("key"))
    keys = keys.filter(F.char_length("key") >= min_chars)
    lines = stored(
        keys.select(
            "doc_id",
            "tid",
            "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit("line"), F.col("key")).alias("h2"),
            batch.alias("batch"),
        ),
        "line-keys",
        "batch",
    )
    runs = LineRuns(spark, buckets, fan_in)
    repeats = None
    for number in range(len(set(bounds)) + 1):
        found = runs.add(lines.filter(F.col("batch") == number)).withColumn("batch", F.lit(number))
        repeats = found if repeats is None else repeats.unionAll(found)
    # A hash of a common line has a row for every document here; the join's two plain
    # exchanges let adaptive execution split it.
    drops = (
        lines.join(repeats, ["batch", *_HASH])
        .filter(F.col("holder") < F.col("doc_id"))
        .groupBy("doc_id", "tid")
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    )
    return rows.join(drops, ["doc_id", "tid"], "left").select(
        "row",
        F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )


def _kept_text() -> Column:
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    kept = F.array_join(F.transform(places, lambda i: F.get("lines", i)), "\n")
    return F.when(F.size("dropped") == 0, F.coalesce("row.text", F.lit(""))).otherwise(kept)


def line_dedup_report(
    docs: DataFrame, min_chars: int = 10, batches: int = 4, fan_in: int = 3, buckets: int | None = None
) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_text for every row of ``docs`` (doc_id, text).

    A line whose key (stripped, A-Z lower-cased) has at least ``min_chars`` code points and
    occurs in two or more documents stays only in the document with the smallest doc_id.
    A null or empty text has one empty line. A row without a doc_id is no holder and keeps all its
    lines. Rows with the same doc_id are one document: each keeps or loses its lines alike.
    Keys are compared by 128 bits of hash. ``batches`` only cuts the work; the result is the same.
    """
    marked = _marked(docs.select("doc_id", "text"), min_chars, batches, fan_in, buckets)
    return marked.select(
        "row.doc_id",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size("dropped").cast("bigint").alias("n_dropped"),
        _kept_text().alias("kept_text"),
    )


def drop_repeated_lines(
    docs: DataFrame, min_chars: int = 10, batches: int = 4, fan_in: int = 3, buckets: int | None = None
) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``; rows and other columns stay as they are.

    A null text stays null.
    """
    marked = _marked(docs, min_chars, batches, fan_in, buckets)
    text = F.when(F.col("row.text").isNotNull(), _kept_text()).alias("text")
    return marked.select(*(text if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))
