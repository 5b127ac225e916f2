"""Removal of passages that repeat an earlier document, by super-k-mer partitioning.

A window is 50 consecutive words. Its minimiser is the least hash of the 8-word runs inside, so
equal windows have equal minimisers, and consecutive windows mostly share one: together they are a
super-k-mer, one packed string of words. Strings travel to the bucket of their minimiser, where
sorting their windows finds the first document of each. Three things keep the travel small:

- a minimiser seen in one document only cannot belong to a repeated window;
- equal strings are counted before anything is sent, and one of them stands for all;
- a minimiser with a single string needs no bucket: its first document holds every window.

A minimiser with very many different strings would be a hot bucket. Its strings are cut into
windows where they are, and only window hashes travel, grouped by themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import stored
from .text import PLAIN, Words, groups_by_size, range_hashes, sequence_hashes, texts_of

WINDOW = 50
MINIMISER = 8
_LONGEST_RUN = 4096
_MASK_SEEDS = (1, 2)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in three passes at any width."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def super_kmers(words: Words, window: int, size: int) -> tuple[np.ndarray, ...]:
    """(document, first word, windows, minimiser, hash of the string) of every super-k-mer."""
    least = sliding_min(sequence_hashes(words.hashes, size), window - size + 1)
    doc = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
    at = np.flatnonzero(doc[: len(least)] == doc[window - 1 : window - 1 + len(least)])
    if not len(at):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    new = np.ones(len(at), dtype=bool)
    new[1:] = (np.diff(at) != 1) | (least[at[1:]] != least[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at)))
    # Very long runs, as in texts of one word, are cut so that strings stay short.
    cuts = -(-length // _LONGEST_RUN)
    part = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    start = at[np.repeat(first, cuts)] + part * _LONGEST_RUN
    count = np.minimum(np.repeat(length, cuts) - part * _LONGEST_RUN, _LONGEST_RUN)
    packed = range_hashes(words.hashes, start, start + count + window - 1)
    return doc[start], start - words.bounds[doc[start]], count, least[start], packed


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _runs(window: int, size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            docs, tids = batch.column("doc_id").to_numpy(), batch.column("tid").to_numpy()
            for part in groups_by_size(texts):
                words = Words([texts[i] for i in part], PLAIN)
                doc, start, count, least, packed = super_kmers(words, window, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(docs[part.start + doc]),
                        pa.array(tids[part.start + doc]),
                        pa.array(start.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        _signed(least),
                        _signed(packed),
                    ],
                    names=["doc_id", "tid", "start", "windows", "minimiser", "packed"],
                )

    return cut


_STRINGS = "minimiser bigint, packed bigint, holder bigint, words binary, place int, w1 bigint, w2 bigint, hot boolean"


def _strings(window: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, parts = batch.column("doc_id").to_pylist(), batch.column("parts").to_pylist()
            for i, text in enumerate(texts_of(batch)):
                words, rows = Words([text], PLAIN), []
                starts = np.array([p["start"] for p in parts[i]])
                stops = starts + np.array([p["windows"] for p in parts[i]]) + window - 1
                inside = stops <= len(words.hashes)
                same = range_hashes(words.hashes, starts[inside], stops[inside]).view(np.int64)
                for p, a, b, packed in zip(np.array(parts[i])[inside], starts[inside], stops[inside], same.tolist()):
                    if packed != p["packed"]:
                        continue  # another row with this doc_id is meant
                    if not p["hot"]:
                        rows.append((p["minimiser"], packed, docs[i], words.joined(a, b), None, None, None, False))
                        continue
                    w1, w2 = (sequence_hashes(words.hashes[a:b], window, s).view(np.int64).tolist() for s in _MASK_SEEDS)
                    rows.extend(
                        (p["minimiser"], packed, docs[i], None, at, x, y, True) for at, (x, y) in enumerate(zip(w1, w2))
                    )
                if rows:
                    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
                    names = [c.split()[0] for c in _STRINGS.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return send


_SPANS = pa.list_(pa.struct([("place", pa.int32()), ("windows", pa.int32()), ("holder", pa.int64())]))


def first_holders(strings: list[bytes], holders: np.ndarray, window: int) -> list[list[tuple[int, int, int]]]:
    """For each string, stretches of windows (first, how many) with the least holder of each window."""
    words = Words(strings, PLAIN)
    size = np.diff(words.bounds) - window + 1
    string = np.repeat(np.arange(len(strings)), size)
    place = np.arange(len(string)) - np.repeat(np.cumsum(size) - size, size)
    at = words.bounds[string] + place
    w1, w2 = (sequence_hashes(words.hashes, window, seed)[at] for seed in _MASK_SEEDS)
    order = np.lexsort((holders[string], w2, w1))
    first = np.ones(len(order), dtype=bool)
    first[1:] = (np.diff(w1[order]) != 0) | (np.diff(w2[order]) != 0)
    least = np.empty(len(order), dtype=np.int64)
    least[order] = holders[string][order][first][np.cumsum(first) - 1]
    edge = np.flatnonzero(np.append(True, (np.diff(least) != 0) | (np.diff(string) != 0))) if len(least) else []
    spans: list[list[tuple[int, int, int]]] = [[] for _ in strings]
    for a, b in zip(edge, np.append(edge[1:], len(least)) if len(edge) else []):
        spans[string[a]].append((int(place[a]), int(b - a), int(least[a])))
    return spans


def _bucket(window: int, limit: int = 1 << 22):
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        spans = first_holders([r[3] for r in rows], np.array([r[2] for r in rows], dtype=np.int64), window)
        listed = [[{"place": a, "windows": n, "holder": h} for a, n, h in s] for s in spans]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(listed, _SPANS)],
            names=["minimiser", "packed", "spans"],
        )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by minimiser; all strings of some minimisers are sorted together."""
        held: list[tuple] = []
        size = 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("minimiser", "packed", "holder", "words"))
            for row in zip(*columns):
                if size >= limit and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)

    return sort


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, kept = [], [], []
        for text, gaps in zip(texts_of(batch), batch.column("gaps").to_pylist()):
            words = (text or b"").split()
            counts.append(len(words))
            if gaps:
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for gap in gaps:
                    gone[gap["first"]] += 1
                    gone[gap["stop"]] -= 1
                stay = np.cumsum(gone)[:-1] == 0
                words = [w for w, keep in zip(words, stay.tolist()) if keep]
            removed.append(counts[-1] - len(words))
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                pa.array(counts, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["row", "n_words", "n_removed", "kept_text"],
        )


def remove_repeated_passages(
    docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, bucket_strings: int = 4096
) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text for every row of ``docs`` (doc_id, text).

    A word goes if a window covers it whose words also stand in a document with a smaller doc_id. Kept words
    are joined by single blanks. Null and empty texts have no words. Rows without a doc_id neither
    lose words nor make others lose them; rows with one doc_id are one document, and equal
    rows lose the same words. Strings and windows are compared by 128 bits of hash.
    A minimiser with more than ``bucket_strings`` strings is sorted by windows instead.
    """
    rows = docs.select(
        F.struct(F.col("doc_id")).alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.lit("row"), F.col("text")).alias("tid"),
        "text",
    )
    named = rows.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "tid", "text")
    runs = stored(
        named.mapInArrow(
            _runs(window, minimiser),
            "doc_id bigint, tid bigint, start int, windows int, minimiser bigint, packed bigint",
        ),
        "runs",
    )
    seen = runs.groupBy("minimiser").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    # Stored, here and below: next to an aggregate on its key, adaptive execution would not split a hot key of the join.
    seen = stored(seen.filter("first < last").select("minimiser"), "shared-minimisers")
    runs = stored(runs.join(seen, "minimiser", "left_semi"), "shared-runs")
    key = ["minimiser", "packed"]
    strings = runs.groupBy(*key).agg(F.min(F.struct("doc_id", "start", "windows")).alias("one")).select(*key, "one.*")
    counts = stored(strings.groupBy("minimiser").agg(F.count(F.lit(1)).alias("n")), "string-counts")
    strings = stored(strings.join(counts, "minimiser"), "strings")
    span = F.struct(F.lit(0).alias("place"), "windows", F.col("doc_id").alias("holder"))
    alone = strings.filter("n = 1").select(*key, F.array(span).alias("spans"))
    parts = F.collect_list(F.struct("start", "windows", *key, (F.col("n") > bucket_strings).alias("hot")))
    sent = strings.filter("n > 1").groupBy("doc_id").agg(parts.alias("parts"))
    sent = named.select("doc_id", "text").join(sent, "doc_id").mapInArrow(_strings(window), _STRINGS)
    sent = stored(sent, "packed", "hot")
    bucketed = (
        sent.filter("NOT hot")
        .select(*key, "holder", "words")
        .repartition("minimiser")
        .sortWithinPartitions("minimiser")
        .mapInArrow(_bucket(window), "minimiser bigint, packed bigint, spans array<struct<place:int,windows:int,holder:bigint>>")
    )
    single = sent.filter("hot").select(*key, "place", "holder", "w1", "w2")
    least = stored(single.groupBy("w1", "w2").agg(F.min("holder").alias("least")), "least-holders")
    single = (
        single.join(least, ["w1", "w2"])
        .groupBy(*key)
        .agg(F.collect_list(F.struct("place", F.lit(1).alias("windows"), F.col("least").alias("holder"))).alias("spans"))
    )
    holders = alone.unionByName(bucketed).unionByName(single)
    earlier = F.filter("spans", lambda s: s["holder"] < F.col("doc_id"))
    gap = F.transform(
        earlier,
        lambda s: F.struct(
            (F.col("start") + s["place"]).alias("first"),
            (F.col("start") + s["place"] + s["windows"] + F.lit(window - 1)).alias("stop"),
        ),
    )
    gaps = (
        runs.join(holders, key)
        .select("doc_id", "tid", gap.alias("gaps"))
        .filter(F.size("gaps") > 0)
        .groupBy("doc_id", "tid")
        .agg(F.flatten(F.collect_list("gaps")).alias("gaps"))
    )
    marked = rows.join(gaps, ["doc_id", "tid"], "left").select("row", "text", "gaps")
    schema = f"row {marked.schema['row'].dataType.simpleString()}, n_words bigint, n_removed bigint, kept_text string"
    return marked.mapInArrow(_cut, schema).select("row.doc_id", "n_words", "n_removed", "kept_text")
