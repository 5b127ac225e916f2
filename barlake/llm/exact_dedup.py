"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Each partition normalises its texts and hashes them; rows are written to a table bucketed by partition, so that later steps
   read a partition's rows where they lie.
2. A partition sorts its distinct fingerprints, cuts them at the owners' ranges, and sends each owner the gaps
   in a Golomb code. Fingerprints have ten bits more than are needed to number the rows: about twelve bits travel a row.
3. An owner decodes what it got and answers each partition with a bitmap: which of its fingerprints others have too.
4. Rows whose fingerprint repeats, in their own partition or elsewhere, are suspects. Only their texts are shuffled, one copy of
   each a partition, and grouped byte by byte. All other rows are unique and never travel.
"""

from __future__ import annotations

import struct
from contextlib import contextmanager
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.session import Stage

from .storage import shuffle_partitions, stored

#: One of 2**10 unique rows becomes a suspect by chance.
SPARE_BITS = 10
_BLANKS = r"[\x20\x09-\x0D]+"
_HEADER = struct.Struct("<QQQ")  # values, parameter, bytes of the unary part


# --------------------------------------------------------------------------
# Golomb code


def golomb_parameter(mean: float) -> int:
    """The best parameter for gaps with this mean."""
    return max(1, round(mean * 0.6931))


def golomb_encode(gaps: np.ndarray, parameter: int) -> bytes:
    """Quotients in unary, then remainders in truncated binary: all leading bits, then the last bits of the longer ones."""
    gaps = gaps.astype(np.uint64)
    quotients, rest = gaps // np.uint64(parameter), gaps % np.uint64(parameter)
    ends = np.cumsum(quotients.astype(np.int64) + 1)
    unary = np.ones(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    unary[ends - 1] = 0
    unary = np.packbits(unary).tobytes()
    bits = (parameter - 1).bit_length()
    if not bits:
        return _HEADER.pack(len(gaps), parameter, len(unary)) + unary
    short = np.uint64((1 << bits) - parameter)
    long = rest >= short
    rest[long] += short
    leading = np.where(long, rest >> np.uint64(1), rest)
    places = np.arange(bits - 2, -1, -1, dtype=np.uint64)
    leading = ((leading[:, None] >> places) & np.uint64(1)).astype(np.uint8)
    last = (rest[long] & np.uint64(1)).astype(np.uint8)
    remainders = np.packbits(np.concatenate([leading.ravel(), last])).tobytes()
    return _HEADER.pack(len(gaps), parameter, len(unary)) + unary + remainders


def golomb_decode(data: bytes) -> np.ndarray:
    count, parameter, size = _HEADER.unpack_from(data)
    unary = np.unpackbits(np.frombuffer(data, np.uint8, size, _HEADER.size))
    ends = np.flatnonzero(unary == 0)[:count]
    quotients = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    bits = (parameter - 1).bit_length()
    if not bits:
        return quotients
    rest = np.unpackbits(np.frombuffer(data, np.uint8, offset=_HEADER.size + size))
    leading = rest[: count * (bits - 1)].reshape(count, bits - 1)
    remainders = np.zeros(count, dtype=np.uint64)
    for place in range(bits - 1):
        remainders = (remainders << np.uint64(1)) | leading[:, place]
    short = np.uint64((1 << bits) - parameter)
    long = remainders >= short
    last = rest[count * (bits - 1) :][: int(long.sum())].astype(np.uint64)
    remainders[long] = (remainders[long] << np.uint64(1)) + last - short
    return quotients * np.uint64(parameter) + remainders


# --------------------------------------------------------------------------
# Exchange


class _Ranges:
    """Fingerprints of ``bits`` bits, and the range of them that each owner holds."""

    def __init__(self, rows: int, owners: int):
        self.bits = min(63, max(1, rows - 1).bit_length() + SPARE_BITS)
        self.owners = owners
        self.width = -(-(1 << self.bits) // owners)

    def values(self, hashes: np.ndarray) -> np.ndarray:
        return hashes.astype(np.int64).view(np.uint64) >> np.uint64(64 - self.bits)

    def cuts(self, values: np.ndarray) -> np.ndarray:
        """Where the values of each owner start in sorted values, and the end of the last."""
        return np.searchsorted(values, np.arange(self.owners + 1, dtype=np.uint64) * np.uint64(self.width))

    def gaps(self, values: np.ndarray, owner: int) -> np.ndarray:
        return np.diff(values, prepend=np.uint64(owner * self.width)) - (np.arange(len(values)) > 0).astype(np.uint64)

    def back(self, gaps: np.ndarray, owner: int) -> np.ndarray:
        return np.cumsum(gaps, dtype=np.uint64) + np.uint64(owner * self.width) + np.arange(len(gaps), dtype=np.uint64)


def _sender(ranges: _Ranges):
    def send(rows: pa.Table) -> pa.Table:
        values = np.unique(ranges.values(rows.column("hash").to_numpy()))
        cuts = ranges.cuts(values)
        owners = np.flatnonzero(np.diff(cuts))
        coded = []
        for owner in owners.tolist():
            own = values[cuts[owner] : cuts[owner + 1]]
            coded.append(golomb_encode(ranges.gaps(own, owner), golomb_parameter(ranges.width / len(own))))
        part = rows.column("part")[0].as_py()
        return pa.table(
            {
                "part": pa.array([part] * len(owners), pa.int32()),
                "owner": pa.array(owners, pa.int32()),
                "coded": pa.array(coded, pa.binary()),
            }
        )

    return send


def _owner(ranges: _Ranges):
    def answer(sent: pa.Table) -> pa.Table:
        owner = sent.column("owner")[0].as_py()
        lists = [ranges.back(golomb_decode(x), owner) for x in sent.column("coded").to_pylist()]
        values = np.concatenate(lists)
        order = np.argsort(values, kind="stable")
        ranked = values[order]
        same = np.zeros(len(values) + 1, dtype=bool)
        same[1:-1] = ranked[1:] == ranked[:-1]
        repeated = np.empty(len(values), dtype=bool)
        repeated[order] = same[1:] | same[:-1]
        stops = np.cumsum([len(x) for x in lists])
        bits = [np.packbits(x).tobytes() for x in np.split(repeated, stops[:-1])]
        return pa.table({"part": sent.column("part"), "owner": sent.column("owner"), "bits": pa.array(bits, pa.binary())})

    return answer


def _marker(ranges: _Ranges):
    def mark(rows: pa.Table, answers: pa.Table) -> pa.Table:
        """A bitmap of the partition's suspects by place, in words of 64 bits."""
        values, inverse, counts = np.unique(
            ranges.values(rows.column("hash").to_numpy()), return_inverse=True, return_counts=True
        )
        cuts, repeated = ranges.cuts(values), counts > 1
        for owner, bits in zip(answers.column("owner").to_pylist(), answers.column("bits").to_pylist()):
            first, last = cuts[owner], cuts[owner + 1]
            repeated[first:last] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=last - first).astype(bool)
        places = rows.column("place").to_numpy()
        words = np.zeros((places.max() // 64 + 1) * 64, dtype=np.uint8)
        words[places] = repeated[inverse]
        words = np.packbits(words, bitorder="little").view("<i8")
        return pa.table(
            {
                "part": rows.column("part")[:1],
                "suspects": pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(words, pa.int64())),
            }
        )

    return mark


@contextmanager
def _one_file_a_task(spark: SparkSession):
    """Rows of a task go to one bucket, so they need no sort before they are written."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def normalised(text: Column) -> Column:
    """Every run of blanks as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _BLANKS, " ")


def exact_duplicates(docs: DataFrame, owner_rows: int = 2_000_000, with_rows: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of ``docs`` (doc_id, text).

    Texts are equal if they are after each run of blanks has become one space; null counts as empty. Of equal texts
    the row with the smallest doc_id stays. A null doc_id comes after all others; if rows share text and doc_id
    one of them stays, so that every group keeps exactly one row. keep_id is null for a group without doc_ids. An
    empty table gives no rows. ``with_rows`` adds the input's columns as ``row``; other columns of the
    input are not looked at.

    ``owner_rows`` bounds the fingerprints an owner holds. A text that fills a third of all rows is sent once by a
    partition, and its copies are counted before they are shuffled.
    """
    spark = docs.sparkSession
    text = normalised(F.col("text"))
    rows = docs.select(
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("hash"),
        F.sha2(text, 256).alias("text_sha256"),
        text.alias("text"),
        *([F.struct(*(docs[c] for c in docs.columns)).alias("row")] if with_rows else []),
    )
    with Stage(spark) as stage:
        with _one_file_a_task(spark):
            rows = stage.store(rows, buckets=shuffle_partitions(spark), by="part")
        return _judged(rows, rows.count(), owner_rows, with_rows)


def _judged(rows: DataFrame, count: int, owner_rows: int, with_rows: bool) -> DataFrame:
    spark = rows.sparkSession
    owners = max(1, ceil(count / owner_rows), min(shuffle_partitions(spark), ceil(count / 4096)))
    ranges = _Ranges(count, owners)
    hashes = rows.select("part", "place", "hash")
    sent = hashes.groupBy("part").applyInArrow(_sender(ranges), "part int, owner int, coded binary")
    answers = sent.groupBy("owner").applyInArrow(_owner(ranges), "part int, owner int, bits binary")
    bitmaps = hashes.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
        _marker(ranges), "part int, suspects array<bigint>"
    )
    bitmaps = stored(bitmaps, "suspects")
    # Read where they lie: of this join only the bitmaps are shuffled.
    word = F.get("suspects", (F.col("place") / 64).cast("int"))
    is_suspect = F.getbit(word, F.pmod("place", F.lit(64)).cast("int")) == 1
    marked = rows.join(bitmaps.hint("shuffle_hash"), "part")
    suspects, others = marked.filter(is_suspect), marked.filter(~is_suspect)

    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "part", "place")).alias("first")
    groups = suspects.groupBy("hash", "text_sha256", "text").agg(first, F.count(F.lit(1)).alias("group_size"))
    # Stored, so that adaptive execution can split the rows of a large group in the join.
    groups = stored(groups.select("hash", "text_sha256", "first", "group_size"), "equal-texts")
    extra = ["row"] if with_rows else []
    of_group = suspects.select("hash", "text_sha256", "part", "place", "doc_id", *extra).join(groups, ["hash", "text_sha256"])
    stays = (F.col("part") == F.col("first.part")) & (F.col("place") == F.col("first.place"))
    judged = of_group.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", stays.alias("kept"), "text_sha256", *extra)
    alone = others.select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
        *extra,
    )
    return stored(judged.unionAll(alone), "exact-duplicates")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with one of each group of equal texts left, see ``exact_duplicates``."""
    return exact_duplicates(docs, with_rows=True).filter("kept").select("row.*")
