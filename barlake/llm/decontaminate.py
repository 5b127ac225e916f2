"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A window is 13 consecutive words of a benchmark item, or the whole item if it has fewer.
Windows of one length share a shift table over blocks of words: the block under the end
of the search position says how far to move on without missing a window. A shift of
zero leads to the bucket of windows that end in this block; the prefix block and then the words
themselves are compared. Many search positions move at once, one for each stretch of text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .storage import stored
from .text import LETTERS, Words, groups_by_size, mix, texts_of

WINDOW = 13
_STRETCH = 128
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def _block_hash(hashes: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(len(ends), dtype=np.uint64)
    for i in range(size):
        total += hashes[ends - i] * _FACTORS[i]
    return mix(total)


class WuManber:
    """Search tables for windows of one length, each a tuple (words joined by blanks, item ids)."""

    def __init__(self, length: int, windows: list[tuple[bytes, list[int]]]):
        self.length = length
        self.block = min(len(_FACTORS), length)
        self.texts = [w for w, _ in windows]
        self.items = [i for _, i in windows]
        hashes = Words([b" ".join(self.texts)], LETTERS).hashes
        self.words = hashes.reshape(len(windows), length)
        self.bits = max(8, min(22, int(np.ceil(np.log2(4 * len(windows) * length)))))
        self.shift = np.full(1 << self.bits, length - self.block + 1, dtype=np.int64)
        first = np.arange(len(windows)) * length
        for end in range(self.block - 1, length):
            at = self._slot(_block_hash(hashes, first + end, self.block))
            np.minimum.at(self.shift, at, length - 1 - end)
        suffix = self._slot(_block_hash(hashes, first + length - 1, self.block))
        self.order = np.argsort(suffix, kind="stable")
        self.bucket = np.searchsorted(suffix[self.order], np.arange((1 << self.bits) + 1))
        self.prefix = _block_hash(hashes, first + self.block - 1, self.block)

    def _slot(self, block_hash: np.ndarray) -> np.ndarray:
        return (block_hash >> np.uint64(64 - self.bits)).astype(np.int64)

    def _stops(self, words: Words) -> np.ndarray:
        """Positions of last words where some window may end."""
        first, last = words.bounds[:-1] + self.length - 1, words.bounds[1:]
        counts = np.maximum(0, -(-(last - first) // _STRETCH))
        lane = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.repeat(first, counts) + lane * _STRETCH
        limit = np.minimum(at + _STRETCH, np.repeat(last, counts))
        found = []
        while len(at):
            move = self.shift[self._slot(_block_hash(words.hashes, at, self.block))]
            found.append(at[move == 0])
            at = at + np.maximum(move, 1)
            on = at < limit
            at, limit = at[on], limit[on]
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def search(self, words: Words) -> Iterator[tuple[int, int]]:
        """(first word, window) of every occurrence."""
        stops = self._stops(words)
        slot = self._slot(_block_hash(words.hashes, stops, self.block))
        begin, end = self.bucket[slot], self.bucket[slot + 1]
        starts = stops - self.length + 1
        prefix = _block_hash(words.hashes, starts + self.block - 1, self.block)
        while len(begin):
            on = begin < end
            begin, end, starts, prefix = begin[on], end[on], starts[on], prefix[on]
            window = self.order[begin]
            same = np.flatnonzero(self.prefix[window] == prefix)
            for i in range(self.length):
                same = same[words.hashes[starts[same] + i] == self.words[window[same], i]]
            for start, w in zip(starts[same].tolist(), window[same].tolist()):
                if words.joined(start, start + self.length) == self.texts[w]:
                    yield start, w
            begin = begin + 1


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _searcher(tables):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in texts_of(pa.RecordBatch.from_struct_array(batch.column("row")))]
            counts, spans, items = [], batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            for part in groups_by_size(texts, 1 << 22):
                words = Words([texts[i] for i in part], LETTERS)
                counts.extend(np.diff(words.bounds).tolist())
                found: dict[int, tuple[list, set]] = {}
                for table in tables.value:
                    for start, window in table.search(words):
                        doc = int(np.searchsorted(words.bounds, start, side="right")) - 1
                        hit = found.setdefault(doc, ([], set()))
                        first = start - int(words.bounds[doc])
                        hit[0].append((first, first + table.length))
                        hit[1].update(table.items[window])
                for doc, (hits, ids) in found.items():
                    row = part.start + doc
                    old = [(s["start"], s["stop"]) for s in spans[row]]
                    spans[row] = [{"start": a, "stop": b} for a, b in _united(old + hits)]
                    items[row] = sorted(ids | set(items[row]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.int64()))],
                names=["row", "n_words", "spans", "items"],
            )

    return search


def _windows(size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, texts, items = [], [], []
            for text, item in zip(texts_of(batch), batch.column("item_id").to_pylist()):
                words = (text or b"").translate(LETTERS).split()
                length = min(size, len(words))
                for i in range(len(words) - length + 1 if words else 0):
                    lengths.append(length)
                    texts.append(b" ".join(words[i : i + length]))
                    items.append(item)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lengths, pa.int32()), pa.array(texts, pa.binary()), pa.array(items, pa.int64())],
                names=["length", "window", "item_id"],
            )

    return cut


def _tables(rows) -> list[WuManber]:
    by_length: dict[int, dict[bytes, list[int]]] = {}
    for r in rows:
        items = by_length.setdefault(r["length"], {}).setdefault(bytes(r["window"]), [])
        if r["item_id"] is not None:
            items.append(r["item_id"])
    return [WuManber(length, sorted(windows.items())) for length, windows in sorted(by_length.items())]


def _found(docs: DataFrame, benchmark: DataFrame, window: int, block_rows: int) -> DataFrame:
    """``row`` (all columns of docs), ``n_words``, ``spans`` and ``items`` for every row of docs."""
    spark = docs.sparkSession
    windows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").mapInArrow(
        _windows(window), "length int, window binary, item_id bigint"
    )
    windows = stored(windows.distinct(), "benchmark-windows")
    blocks = max(1, -(-windows.count() // block_rows))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"),
        F.array().cast("array<bigint>").alias("items"),
    )
    schema = rows.schema
    for block in range(blocks):
        mine = windows.filter(F.pmod(F.xxhash64("length", "window", "item_id"), F.lit(blocks)) == block)
        tables = spark.sparkContext.broadcast(_tables(mine.toLocalIterator()))
        rows = rows.mapInArrow(_searcher(tables), schema)
        if block + 1 < blocks:
            rows = stored(rows, "decontaminate")
    return rows


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_rows: int = 250_000
) -> DataFrame:
    """doc_id, n_words, spans and items for every row of ``docs`` (doc_id, text).

    ``spans`` are the stretches of words inside occurrences of windows of ``benchmark``
    (item_id, text), from ``start`` to before ``stop``, in order and apart. ``items`` are the ids of
    items with an occurring window. Null texts have no words; items without words have no window. An
    item without an id is searched for, but not listed. Rows that occur twice are reported twice.

    The windows are the query set. They are searched in blocks of about ``block_rows``, each
    of which one broadcast holds, so memory has a bound at every size of the benchmark.
    """
    rows = _found(docs.select("doc_id", "text"), benchmark, window, block_rows)
    return rows.select("row.doc_id", "n_words", "spans", "items")


def hit_words(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])


def contaminated(n_words: str = "n_words", spans: str = "spans") -> Column:
    """At least one word in twenty lies in a benchmark passage."""
    return (F.size(spans) > 0) & (20 * hit_words(spans) >= F.col(n_words))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_rows: int = 250_000
) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with their columns."""
    return _found(docs, benchmark, window, block_rows).filter(~contaminated()).select("row.*")
