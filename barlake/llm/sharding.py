"""Sharding by longest-processing-time scheduling.

Rows with equal text stay together. LPT sorts the groups by size and gives each
to the least-loaded shard, which a heap finds. The number of groups grows with
the corpus, the heap's input must not: a group that weighs at least one
``bundles``-th of the whole is scheduled by itself (there are at most ``bundles``
of them), smaller groups are bundled by the hash of their text. The driver sees
the sizes of at most ``2 * bundles`` items, never the groups or rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F

from .storage import stored

ROW_OVERHEAD = 16


def lpt(items: Iterable[tuple[int, int]], shards: int) -> dict[int, int]:
    """Shard of each (item, size): largest first to the least-loaded shard; ties by number."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for item, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        placed[item] = shard
    return placed


def shard_documents(docs: DataFrame, shards: int = 40, bundles: int = 32768, slices: int = 8192) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs`` (doc_id, text).

    ``size`` is the UTF-8 length plus 16. A null text counts as empty and shares the
    group of empty texts; its size is 16. Slots count from 0 without gaps in each
    shard. A null doc_id is a row like any other, and rows that occur twice get a
    slot each. An empty table gives no rows.

    ``slices`` bounds the number of parts in which rows are numbered: a bundle with
    more rows than its share is cut by the hash of the doc_id, so that no task
    numbers all rows of a large group of copies.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("g1"),
        F.xxhash64(F.lit("group"), text).alias("g2"),
    )
    rows = stored(rows, "shard-rows")
    groups = stored(
        rows.groupBy("g1", "g2").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")), "shard-groups"
    )
    whole = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    large = F.col("bytes") * F.lit(bundles) >= F.lit(whole[0])
    # At most ``bundles`` rows. A large group is its own item, numbered after the bundles.
    alone = groups.filter(large).select(
        "g1", "g2", (F.row_number().over(Window.orderBy("g1", "g2")) + F.lit(bundles - 1)).alias("own")
    )
    alone = stored(alone, "shard-large")
    rows = rows.join(F.broadcast(alone), ["g1", "g2"], "left").withColumn(
        "item", F.coalesce(F.col("own"), F.pmod("g1", F.lit(bundles)).cast("int"))
    )
    groups = groups.join(F.broadcast(alone), ["g1", "g2"], "left").withColumn(
        "item", F.coalesce(F.col("own"), F.pmod("g1", F.lit(bundles)).cast("int"))
    )
    items = groups.groupBy("item").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).collect()
    shard_of = lpt(((r["item"], r["bytes"]) for r in items), shards)
    share = max(1, -(-whole[1] // slices))
    cut = [(r["item"], -(-r["rows"] // share)) for r in items]
    spark = docs.sparkSession
    # Both tables below are bounded by 2 * bundles + slices rows.
    slices_of = spark.createDataFrame(cut, "item int, parts bigint")
    rows = rows.join(F.broadcast(slices_of), "item").withColumn(
        "slice", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")
    )
    counts = rows.groupBy("item", "slice").agg(F.count(F.lit(1)).alias("n")).collect()
    filled = [0] * shards
    offsets = []
    for item, part, n in sorted(counts):
        offsets.append((item, part, shard_of[item], filled[shard_of[item]]))
        filled[shard_of[item]] += n
    offsets = spark.createDataFrame(offsets, "item int, slice int, shard int, base bigint")
    place = Window.partitionBy("item", "slice").orderBy("doc_id")
    return rows.join(F.broadcast(offsets), ["item", "slice"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("base") + F.row_number().over(place) - F.lit(1)).alias("slot"),
    )
