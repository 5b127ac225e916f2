"""Hard negatives of anchor vectors, by Kronecker-packed integer products.

Components are scaled to integers. Inside a block the components of anchors and candidates are biased to be
non-negative, and the same component of several candidates is put into separated fields of one wide integer:
one multiplication by the anchor's component serves them all, sums never cross a field, and the fields of the
sum, less the bias terms, are the exact inner products. Where all fields of a word fit 53 bits the wide integers
are held in doubles, which represent them exactly, so that a matrix product does the multiplications; larger
components take words of any length.

Anchors and candidates are dealt over a grid of blocks. A first pass finds each anchor's positives among rows
of its label, a second one its negatives inside the score window of each positive. Blocks return at most as many
rows per anchor as are asked for, and Spark ranks what the blocks return.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import shuffle_partitions, stored

#: Integers up to this size are exact in a double.
_EXACT_BITS = 53
#: Scores are kept inside a long; beyond it they count as this.
_MOST = 2**62
#: Rows of an inner block: anchors, candidates.
_ROWS = 256, 8192


# --------------------------------------------------------------------------
# Packed products


def scaled(vectors: pa.ChunkedArray, scale: int, size: int) -> np.ndarray:
    """floor(scale * x) of every component as whole numbers, one row per vector, filled up with zeros to ``size``.

    Doubles, or Python integers if one is too large to be exact in a double's products.
    """
    lengths = pc.list_value_length(vectors).to_numpy().astype(np.int64)
    flat = np.floor(pc.list_flatten(vectors).to_numpy().astype(np.float64) * scale)
    out = np.zeros((len(lengths), size))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    if len(flat) and np.abs(flat).max() >= 2**_EXACT_BITS:
        return np.array([[int(x) for x in values] for values in out], dtype=object).reshape(out.shape)
    return out


def field_bits(anchors: np.ndarray, candidates: np.ndarray) -> int:
    """Bits of a field that holds any inner product of the biased vectors."""
    wide = lambda rows: int(rows.max()) - int(rows.min())
    return max(1, (anchors.shape[1] * wide(anchors) * wide(candidates)).bit_length())


def products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of all anchors and candidates as 64-bit integers."""
    m, n, size = len(anchors), len(candidates), anchors.shape[1]
    if not (m and n and size):
        return np.zeros((m, n), dtype=np.int64)
    bits = field_bits(anchors, candidates)
    if bits > _EXACT_BITS or anchors.dtype == object or candidates.dtype == object:
        return _long_products(anchors, candidates, bits)
    low_a, low_c = anchors.min(), candidates.min()
    a, c = anchors - low_a, candidates - low_c
    fields = _EXACT_BITS // bits
    words = -(-n // fields)
    packed = np.zeros((words, size))
    for field in range(fields):
        part = c[field * words : (field + 1) * words]
        packed[: len(part)] += part * float(1 << (field * bits))
    sums = (a @ packed.T).astype(np.int64)
    out = np.empty((m, n), dtype=np.int64)
    for field in range(fields):
        part = out[:, field * words : (field + 1) * words]
        part[:] = (sums[:, : part.shape[1]] >> (field * bits)) & ((1 << bits) - 1)
    low_a, low_c = int(low_a), int(low_c)
    out += low_a * c.sum(axis=1).astype(np.int64)
    out += (low_c * a.sum(axis=1).astype(np.int64) + size * low_a * low_c)[:, None]
    return out


def _long_products(anchors: np.ndarray, candidates: np.ndarray, bits: int) -> np.ndarray:
    """The same with words of any length: all candidates of the block are the fields of one integer."""
    a = [[int(x) for x in row] for row in anchors]
    c = [[int(x) for x in row] for row in candidates]
    low_a, low_c = min(map(min, a)), min(map(min, c))
    field = -(-bits // 8)  # bytes
    packed = [b"".join((row[d] - low_c).to_bytes(field, "little") for row in c) for d in range(len(a[0]))]
    packed = [int.from_bytes(word, "little") for word in packed]
    sums = [sum(row) for row in c]
    out = np.empty((len(a), len(c)), dtype=np.int64)
    for i, row in enumerate(a):
        total = sum((x - low_a) * word for x, word in zip(row, packed))
        data = total.to_bytes(field * len(c) + 1, "little")
        # Of x - low_a and y - low_c the sum of products is xy - low_c x - low_a y + low_a low_c.
        rest = low_c * sum(row) - len(row) * low_a * low_c
        for j, own in enumerate(sums):
            score = int.from_bytes(data[j * field : (j + 1) * field], "little") + rest + low_a * own
            out[i, j] = min(max(score, -_MOST), _MOST)
    return out


# --------------------------------------------------------------------------
# Selection in a block


def _levels(scores: np.ndarray, columns: int, rows: int) -> np.ndarray | None:
    """Sorted distinct scores if their span is too wide for one 64-bit key with row and column, else None."""
    span = int(scores.max()) - int(scores.min()) + 2
    return np.unique(scores) if span * columns * rows >= 2**62 else None


def first_of_row(scores: np.ndarray, count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The ``count`` best (rows, columns) of each row, those of the smaller column first among equals."""
    m, n = scores.shape
    levels = _levels(scores, n, 1)
    ranks = scores if levels is None else np.searchsorted(levels, scores)
    keys = (int(ranks.max()) - ranks) * n + np.arange(n)
    if n > count:
        keys = np.partition(keys, count - 1, axis=1)[:, :count]
    columns = (keys % n).ravel()
    return np.repeat(np.arange(m), keys.shape[1]), columns


def first_in_windows(
    scores: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, count: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, windows, columns) of the ``count`` best allowed scores in each window [low, high] of each row."""
    none = np.zeros(0, dtype=np.int64)
    if not scores.size:
        return none, none, none
    inside = allowed & (scores >= low.min(axis=1)[:, None]) & (scores <= high.max(axis=1)[:, None])
    rows, columns = np.nonzero(inside)
    if not len(rows):
        return none, none, none
    found, (m, n) = scores[rows, columns], scores.shape
    levels = _levels(found, n, m)
    if levels is not None:
        found = np.searchsorted(levels, found)
        low, high = np.searchsorted(levels, low), np.searchsorted(levels, high, side="right") - 1
    top, least = int(found.max()), int(found.min())
    span = top - least + 2
    keys = np.sort((rows * span + (top - found)) * n + columns)
    high, low = np.clip(high, least - 1, top), np.clip(low, least, top + 1)
    starts = np.searchsorted(keys, (np.arange(m)[:, None] * span + (top - high)) * n)
    at = starts[:, :, None] + np.arange(count)
    own = keys[np.minimum(at, len(keys) - 1)]
    score = top - own // n % span
    hit = (at < len(keys)) & (own // n // span == np.arange(m)[:, None, None]) & (score >= low[:, :, None])
    rows, windows, _ = np.nonzero(hit)
    return rows, windows, (own % n)[hit]


class _Side:
    """Rows of one side of a cell, by vec_id (null last) and row number."""

    def __init__(self, table: pa.Table, scale: int, size: int):
        order = [("no_id", "ascending"), ("vec_id", "ascending"), ("rid", "ascending")]
        table = table.append_column("no_id", pc.is_null(table.column("vec_id")))
        self.table = table.take(pc.sort_indices(table, sort_keys=order))
        self.rid = self.table.column("rid").to_numpy()
        self.label = self.table.column("label").to_numpy()
        self.vectors = scaled(self.table.column("vector"), scale, size)

    def __len__(self) -> int:
        return len(self.rid)


def _sides(anchors: pa.Table, candidates: pa.Table, scale: int) -> tuple[_Side, _Side]:
    longest = [pc.max(pc.list_value_length(t.column("vector"))).as_py() or 0 for t in (anchors, candidates)]
    return tuple(_Side(t, scale, max(longest)) for t in (anchors, candidates))


def _blocks(m: int, n: int) -> Iterator[tuple[slice, slice]]:
    for i in range(0, m, _ROWS[0]):
        for j in range(0, n, _ROWS[1]):
            yield slice(i, min(i + _ROWS[0], m)), slice(j, min(j + _ROWS[1], n))


def _positives_of(scale: int, count: int):
    def find(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        parts = []
        if anchors.num_rows and candidates.num_rows:
            a, c = _sides(anchors, candidates, scale)
            for label in np.intersect1d(a.label, c.label):
                mine, theirs = np.flatnonzero(a.label == label), np.flatnonzero(c.label == label)
                for i, j in _blocks(len(mine), len(theirs)):
                    rows, columns = mine[i], theirs[j]
                    scores = products(a.vectors[rows], c.vectors[columns])
                    own = a.rid[rows][:, None] == c.rid[columns][None, :]
                    scores[own] = scores.min() - 1  # an anchor is no positive of itself
                    x, y = first_of_row(scores, count)
                    keep = ~own[x, y]
                    x, y = x[keep], y[keep]
                    parts.append((rows[x], columns[y], scores[x, y]))
        if not parts:
            return _POSITIVES.empty_table()
        x, y, score = (np.concatenate(p) for p in zip(*parts))
        ids = [a.table.column("rid").take(x), c.table.column("rid").take(y), c.table.column("vec_id").take(y)]
        return pa.table([*ids, pa.array(score)], schema=_POSITIVES)

    return find


def _negatives_of(scale: int, count: int, slots: int):
    def find(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        parts = []
        if anchors.num_rows and candidates.num_rows:
            a, c = _sides(anchors, candidates, scale)
            low, high = (np.full((len(a), slots), x, dtype=np.int64) for x in (_MOST + 1, -_MOST - 1))
            for name, window in (("low", low), ("high", high)):
                for row, values in enumerate(a.table.column(name).to_pylist()):
                    window[row, : len(values)] = values
            for i, j in _blocks(len(a), len(c)):
                scores = products(a.vectors[i], c.vectors[j])
                allowed = a.label[i][:, None] != c.label[j][None, :]
                x, slot, y = first_in_windows(scores, allowed, low[i], high[i], count)
                parts.append((x + i.start, slot, y + j.start, scores[x, y]))
        if not parts:
            return _NEGATIVES.empty_table()
        x, slot, y, score = (np.concatenate(p) for p in zip(*parts))
        ids = [c.table.column("rid").take(y), c.table.column("vec_id").take(y), pa.array(score)]
        return pa.table([a.table.column("rid").take(x), pa.array(slot.astype(np.int32)), *ids], schema=_NEGATIVES)

    return find


_POSITIVES = pa.schema(
    [("anchor_rid", pa.int64()), ("positive_rid", pa.int64()), ("positive_id", pa.int64()), ("score", pa.int64())]
)
_NEGATIVES = pa.schema(
    [
        ("anchor_rid", pa.int64()),
        ("slot", pa.int32()),
        ("negative_rid", pa.int64()),
        ("negative_id", pa.int64()),
        ("negative_score", pa.int64()),
    ]
)
_DDL = {pa.int64(): "bigint", pa.int32(): "int"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


# --------------------------------------------------------------------------


def _grid(anchors: DataFrame, candidates: DataFrame, tall: int, wide: int, find, schema: pa.Schema) -> DataFrame:
    """``find`` on every pair of an anchor chunk and a candidate chunk."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n: F.pmod(F.xxhash64("rid"), F.lit(n)).cast("int")
    left = anchors.withColumn("i", own(tall)).withColumn("j", every(wide))
    right = candidates.withColumn("j", own(wide)).withColumn("i", every(tall))
    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(find, _ddl(schema))


def _ranked(rows: DataFrame, count: int, keys: Sequence[str], score: str, prefix: str, name: str) -> DataFrame:
    """The best ``count`` rows of each key: higher scores, then smaller ids; a null id comes last."""
    order = [F.desc(score), F.asc_nulls_last(f"{prefix}_id"), F.asc(f"{prefix}_rid")]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(name, place).filter(F.col(name) <= count)


def _floor_of(score: Column, part: tuple[int, int]) -> Column:
    product = score.cast("decimal(20,0)") * F.lit(part[0])
    return ((product - F.pmod(product, F.lit(part[1]).cast("decimal(10,0)"))) / F.lit(part[1])).cast("bigint")


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100),
    scale: int = 256,
    chunk_anchors: int = 65_536,
    chunk_rows: int = 131_072,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``rows`` (vec_id, label, vector).

    Scores are inner products of floor(scale * component). Anchors are the rows for which ``is_anchor`` (on
    vec_id and label) is true. An anchor's positives are the first other rows of its label, its negatives for
    a positive the first rows of other labels whose score is between the fractions ``low`` and ``high`` of the
    positive's; higher scores come first, then smaller vec_ids.

    Rows with a null label, a null vector, or any null, infinite or NaN component take no part. A row
    without vec_id is no anchor; as a candidate it comes after others with its score. Rows that occur twice are rows of their
    own: each is an anchor, and the other one can be its positive. Missing components of shorter vectors count
    as zero, an empty vector scores zero with all. A score beyond 2**62 counts as 2**62. An anchor without
    positives, or without negatives, gives no rows; neither does an empty table. Other columns are ignored.

    ``chunk_anchors`` and ``chunk_rows`` bound what a task holds. Anchors travel once per chunk of candidates
    and candidates once per chunk of anchors.
    """
    spark = rows.sparkSession
    finite = F.forall("vector", lambda x: F.abs(x.cast("double")) * scale < F.lit(float("inf")))
    part = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), "vector")
    part = part.filter("label IS NOT NULL AND vector IS NOT NULL").filter(finite)
    part = stored(part.select("*", is_anchor.alias("is_anchor"), F.monotonically_increasing_id().alias("rid")), "vectors")
    anchors = part.filter("is_anchor AND vec_id IS NOT NULL")
    n, m = part.count(), anchors.count()
    tall = max(1, ceil(m / chunk_anchors))
    wide = max(1, ceil(n / chunk_rows), min(shuffle_partitions(spark), ceil(n / 512)))
    columns = ["rid", "vec_id", "label", "vector"]
    candidates = part.select(*columns)

    near = _grid(anchors.select(*columns), candidates, tall, wide, _positives_of(scale, positives), _POSITIVES)
    near = stored(_ranked(near, positives, ["anchor_rid"], "score", "positive", "place"), "positives")
    slots = near.groupBy("anchor_rid").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "score"))).alias("found"))
    windowed = stored(
        anchors.select(*columns)
        .join(slots, F.col("rid") == F.col("anchor_rid"))
        .select(
            *columns,
            "found",
            # At least a fraction is at least its ceiling, which is the floor with both signs turned.
            F.transform("found", lambda x: -_floor_of(-x["score"], low)).alias("low"),
            F.transform("found", lambda x: _floor_of(x["score"], high)).alias("high"),
        ),
        "windows",
    )
    hard = _grid(
        windowed.select(*columns, "low", "high"), candidates, tall, wide, _negatives_of(scale, negatives, positives), _NEGATIVES
    )
    hard = stored(_ranked(hard, negatives, ["anchor_rid", "slot"], "negative_score", "negative", "rank"), "negatives")
    found = F.get("found", F.col("slot"))
    return hard.join(windowed.select(F.col("rid").alias("anchor_rid"), F.col("vec_id").alias("anchor_id"), "found"), "anchor_rid").select(
        "anchor_id",
        found["positive_id"].alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        "negative_id",
        found["score"].alias("positive_score"),
        "negative_score",
    )
