"""Katz backoff language model, trained and applied in partitioned tables.

P(w | h) is the Good-Turing discounted frequency of the pair if training has it, otherwise the
backoff weight of h times P(w); P(w) backs off in the same way to one type for all unknown
words. Weights make every distribution sum to one exactly: leftover mass over unseen mass.

Texts are read once, into chunks of some million tokens. A chunk asks for its distinct words and pairs,
sorted and cut by hash range; the task of a range adds up the counts of all chunks and answers each.
A frequent word or pair occurs once per chunk in these tables, so that no key is hot. Sums over
the followers of a word are formed in the same way: the first chunk that asked for a pair owns it.

Pairs are the longest n-grams. With triples the tables of a corpus whose word triples
hardly repeat would be larger than the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .storage import shuffle_partitions, stored
from .text import LOWER, Words, groups_by_size, mix, texts_of

CUTOFF = 5
FOLDS, HELD_OUT = 7, 2
_END, _BEGIN = np.uint64(0x8F1BBCDC5A827999), np.uint64(0xCA62C1D66ED9EBA1)
_BEFORE, _AFTER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _dump(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)


def _load(data: bytes, kind=np.uint64) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _dump_sorted(keys: np.ndarray) -> bytes:
    return _dump(np.diff(keys, prepend=np.uint64(0)))


def _load_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_load(data), dtype=np.uint64)


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each of ``parts`` equal hash ranges starts in sorted keys."""
    bounds = np.array([(i << 64) // parts for i in range(1, parts)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])


# --------------------------------------------------------------------------
# Chunks


class Chunk:
    """Some documents as local word numbers; ``vocabulary`` holds word hashes, frequent ones first."""

    def __init__(self, vocabulary: np.ndarray, tokens: np.ndarray, ends: np.ndarray, train: np.ndarray):
        self.vocabulary, self.tokens, self.ends, self.train = vocabulary, tokens, ends, train

    @classmethod
    def of(cls, hashes: list[np.ndarray], ids: list) -> Chunk:
        flat = np.concatenate([x for h in hashes for x in (h, [_END])]).astype(np.uint64)
        found, at, count = np.unique(flat, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(order), dtype=np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        folds = [zlib.crc32(("" if i is None else str(i)).encode()) % FOLDS for i in ids]
        return cls(
            found[order],
            rank[at],
            np.cumsum([len(h) + 1 for h in hashes]),
            np.array([f != HELD_OUT for f in folds], dtype=bool),
        )

    def words(self):
        """Sorted word hashes, their local numbers, and their counts in training."""
        count = np.bincount(self.tokens[self.in_training()], minlength=len(self.vocabulary))
        order = np.argsort(self.vocabulary)
        return self.vocabulary[order], order, count[order].astype(np.uint64)

    def pairs(self):
        """Sorted pair hashes, the pair of each token, the token where each pair is first, counts in training."""
        first = self.ends - np.diff(self.ends, prepend=0)
        after = self.vocabulary[self.tokens]
        before = np.concatenate([[_BEGIN], after[:-1]])
        before[first] = _BEGIN
        keys = mix(before * _BEFORE + after * _AFTER)
        found, where, at = np.unique(keys, return_index=True, return_inverse=True)
        count = np.bincount(at[self.in_training()], minlength=len(found))
        return found, at, where, count.astype(np.uint64)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))

    def in_training(self) -> np.ndarray:
        return np.repeat(self.train, np.diff(self.ends, prepend=0))


_CHUNKS = "chunk bigint, doc_ids array<bigint>, vocabulary binary, tokens binary, ends binary, train binary, size bigint, trained bigint"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _chunker(limit: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        hashes: list[np.ndarray] = []
        ids: list = []
        size = 0

        def flush() -> pa.RecordBatch:
            chunk = Chunk.of(hashes, ids)
            row = [number, ids, _dump(chunk.vocabulary), _dump(chunk.tokens), _dump(chunk.ends), _dump(chunk.train)]
            row += [len(chunk.tokens), int(chunk.train.sum())]
            kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4, pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=_names(_CHUNKS))

        for batch in batches:
            texts, docs = texts_of(batch), batch.column("doc_id").to_pylist()
            for part in groups_by_size(texts):
                words = Words([texts[i] or b"" for i in part], LOWER)
                for i, a, b in zip(part, words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
                    hashes.append(words.hashes[a:b])
                    ids.append(docs[i])
                    size += b - a + 1
                    if size >= limit:
                        yield flush()
                        number, hashes, ids, size = number + 1, [], [], 0
        if ids:
            yield flush()

    return read


def _chunk_of(row: dict) -> Chunk:
    return Chunk(
        _load(row["vocabulary"]), _load(row["tokens"], np.uint32), _load(row["ends"], np.int64), _load(row["train"], bool)
    )


# --------------------------------------------------------------------------
# Counts: level 1 words, level 2 pairs

_ASKED = "level int, part int, chunk bigint, keys binary, counts binary"


def _asker(parts: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _chunk_of(row)
                rows = []
                words, _, word_counts = chunk.words()
                pairs, _, _, pair_counts = chunk.pairs()
                for level, keys, counts in ((1, words, word_counts), (2, pairs, pair_counts)):
                    cuts = _cuts(keys, parts)
                    for part in range(parts):
                        own = slice(cuts[part], cuts[part + 1])
                        rows.append((level, part, row["chunk"], _dump_sorted(keys[own]), _dump(counts[own])))
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=_names(_ASKED)
                )

    return ask


_TOLD = "level int, part int, chunk bigint, totals binary, owned binary, stats array<bigint>"


def _gather(group: pa.Table, column: str):
    """Rows by chunk with their sorted keys, and all keys with the place of each among the distinct ones."""
    rows = sorted(group.to_pylist(), key=lambda r: r["chunk"])
    keys = [_load_sorted(r[column]) for r in rows]
    found, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    return rows, np.cumsum([0, *map(len, keys)]), found, first, at


def _count(group: pa.Table) -> pa.Table:
    rows, bounds, found, first, at = _gather(group, "keys")
    totals = np.zeros(len(found), dtype=np.uint64)
    for row, a, b in zip(rows, bounds, bounds[1:]):
        totals[at[a:b]] += _load(row["counts"])
    owned = np.zeros(len(at), dtype=bool)
    owned[first] = True
    few = np.bincount(np.minimum(totals, CUTOFF + 2).astype(np.int64), minlength=CUTOFF + 3)[1 : CUTOFF + 2]
    stats = [int(totals.sum()), int((totals > 0).sum()), *few.tolist()]
    out = [
        (r["level"], r["part"], r["chunk"], _dump(totals[at[a:b]]), _dump(owned[a:b]), None if i else stats)
        for i, (r, a, b) in enumerate(zip(rows, bounds, bounds[1:]))
    ]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=_names(_TOLD))


# --------------------------------------------------------------------------
# Discounts


def good_turing(counts_of_counts: list[int], cutoff: int = CUTOFF) -> np.ndarray:
    """Factor by which a count r is lowered, for r from 0 to ``cutoff + 1``; the last stands for all larger ones.

    Katz's formula from n_1 to n_{cutoff + 1}; where these are too few for a factor between 0 and 1,
    half a count is taken off.
    """
    n = [0, *counts_of_counts]
    factors = np.ones(cutoff + 2)
    common = (cutoff + 1) * n[cutoff + 1] / n[1] if n[1] else 1.0
    for r in range(1, cutoff + 1):
        wanted = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        factor = (wanted - common) / (1 - common) if common != 1 else 0.0
        factors[r] = factor if 0 < factor < 1 else (r - 0.5) / r
    return factors


class Model:
    """What all tasks need to know of the training part; its size does not depend on the corpus."""

    def __init__(self, word_stats: list[int], pair_stats: list[int], trained: int):
        self.tokens, self.types = word_stats[:2]
        self.trained = trained
        self.word_factors = good_turing(word_stats[2:])
        self.pair_factors = good_turing(pair_stats[2:])
        few = np.array(word_stats[2 : 2 + CUTOFF], dtype=float) * np.arange(1, CUTOFF + 1)
        left = float((few * (1 - self.word_factors[1 : CUTOFF + 1])).sum())
        # With no discounted word one count is added, for the unknown type.
        self.scale = self.tokens if left else self.tokens + 1
        self.unknown = (left or 1.0) / self.scale

    def word(self, count: np.ndarray) -> np.ndarray:
        """P(w) by training count; unknown words share one type."""
        seen = self.word_factors[np.minimum(count, CUTOFF + 1).astype(np.int64)] * count / self.scale
        return np.where(count > 0, seen, self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1.0) / (self.tokens + 1.0 * (self.types + 1)))

    def backoff(self, history: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weight, factor of seen pairs) by count of the history and the sums over its followers.

        A history all of whose followers are too frequent for a discount would leave no mass: its count is
        raised by one.
        """
        r = np.arange(1, CUTOFF + 1)
        left = sums[:, :CUTOFF] @ (r * (1 - self.pair_factors[1 : CUTOFF + 1]))
        words = (sums[:, CUTOFF] - sums[:, CUTOFF + 1 :] @ (r * (1 - self.word_factors[1 : CUTOFF + 1]))) / self.scale
        factor = np.where(left > 0, 1.0, history / (history + 1.0))
        mass = np.where(left > 0, left / history, 1.0 / (history + 1.0))
        return mass / (1 - words), factor


# --------------------------------------------------------------------------
# Scores

_SCORED = "chunk bigint, part int, keys binary, sums binary, needed binary, docs binary, words binary, unseen binary, seen binary, ids array<bigint>, values binary"


def _scorer(model: Model, parts: int):
    def score(key, chunk_rows: pa.Table, told: pa.Table) -> pa.Table:
        row = chunk_rows.to_pylist()[0]
        chunk = _chunk_of(row)
        answers = {(r["level"], r["part"]): r for r in told.to_pylist()}
        level = lambda n, column, kind=np.uint64: np.concatenate(
            [_load(answers[n, p][column], kind) for p in range(parts)]
        )
        words, order, _ = chunk.words()
        count = np.empty(len(words), dtype=np.uint64)
        count[order] = level(1, "totals")
        pairs, at, where, _ = chunk.pairs()
        pair_count, owned = level(2, "totals"), level(2, "owned", bool)
        # A history is a local word, or the number after the last one for the begin of a text.
        begin = len(words)
        follower = chunk.tokens[where].astype(np.int64)
        opening = np.zeros(len(chunk.tokens), dtype=bool)
        opening[chunk.ends - np.diff(chunk.ends, prepend=0)] = True
        history = np.where(opening[where], begin, chunk.tokens[where - 1].astype(np.int64))
        history_count = np.append(count, np.uint64(model.trained))
        known = pair_count > 0
        single = np.log10(model.word(count))[follower]
        joint = model.pair_factors[np.minimum(pair_count, CUTOFF + 1).astype(np.int64)] * pair_count
        with np.errstate(divide="ignore", invalid="ignore"):
            value = np.where(known, np.log10(joint / history_count[history]), single)
        doc = chunk.doc_of()
        docs = len(chunk.ends)
        found = count[chunk.tokens]
        values = np.stack(
            [
                np.diff(chunk.ends, prepend=0),
                np.bincount(doc, weights=found > 0, minlength=docs),
                np.bincount(doc, weights=model.base(found), minlength=docs),
                np.bincount(doc, weights=value[at], minlength=docs),
                ~chunk.train,
            ]
        ).astype(np.float64)
        # Followers of each history, each pair at its owner.
        used = history_count[history] > 0
        mine = known & owned
        sums = np.zeros((begin + 1, 2 * CUTOFF + 1), dtype=np.int64)
        small, of = np.minimum(pair_count, CUTOFF + 1).astype(np.int64), history[mine]
        np.add.at(sums, (of[small[mine] <= CUTOFF], small[mine][small[mine] <= CUTOFF] - 1), 1)
        followed = count[follower[mine]].astype(np.int64)
        np.add.at(sums[:, CUTOFF], of, followed)
        rare = followed <= CUTOFF
        np.add.at(sums, (of[rare], CUTOFF + followed[rare]), 1)
        # Occurrences that need the weight of their history, or may need its factor.
        frequent = np.ones(begin + 1, dtype=bool)
        frequent[history[known & (small <= CUTOFF)]] = False
        open_pair = used & (~known | frequent[history])
        tokens = np.flatnonzero(open_pair[at])
        cell, how_many = np.unique(
            np.stack([doc[tokens], history[at[tokens]], known[at[tokens]]]), axis=1, return_counts=True
        ) if len(tokens) else (np.zeros((3, 0), dtype=np.int64), np.zeros(0, dtype=np.int64))
        needed = np.zeros(begin + 1, dtype=bool)
        needed[cell[1]] = True
        asked = np.flatnonzero(needed | (sums[:, CUTOFF] > 0))
        keys = np.append(chunk.vocabulary, _BEGIN)[asked]
        by_key = np.argsort(keys)
        asked, keys = asked[by_key], keys[by_key]
        rank = np.zeros(begin + 1, dtype=np.int64)
        wanted = asked[needed[asked]]
        rank[wanted] = np.arange(len(wanted))
        cuts = _cuts(keys, parts)
        rows = []
        for part in range(parts):
            own = asked[cuts[part] : cuts[part + 1]]
            if len(own):
                table = np.concatenate([history_count[own, None].astype(np.int64), sums[own]], axis=1)
                rows.append(
                    {
                        "chunk": row["chunk"],
                        "part": part,
                        "keys": _dump_sorted(keys[cuts[part] : cuts[part + 1]]),
                        "sums": _dump(table.T.ravel()),
                        "needed": _dump(needed[own]),
                    }
                )
        known_cell = cell[2] > 0
        rows.append(
            {
                "chunk": row["chunk"],
                "docs": _dump(cell[0].astype(np.uint32)),
                "words": _dump(rank[cell[1]].astype(np.uint32)),
                "unseen": _dump(np.where(known_cell, 0, how_many).astype(np.uint32)),
                "seen": _dump(np.where(known_cell, how_many, 0).astype(np.uint32)),
                "ids": row["doc_ids"],
                "values": _dump(values.ravel()),
            }
        )
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 7, pa.list_(pa.int64()), pa.binary()]
        names = _names(_SCORED)
        return pa.table([pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds)], names=names)

    return score


_WEIGHTS = "chunk bigint, part int, weight binary, factor binary"


def _weigher(model: Model):
    def weigh(group: pa.Table) -> pa.Table:
        rows, bounds, found, _, at = _gather(group, "keys")
        history = np.zeros(len(found))
        sums = np.zeros((len(found), 2 * CUTOFF + 1))
        for row, a, b in zip(rows, bounds, bounds[1:]):
            table = _load(row["sums"], np.int64).reshape(-1, b - a).T
            history[at[a:b]] = table[:, 0]
            sums[at[a:b]] += table[:, 1:]
        with np.errstate(divide="ignore", invalid="ignore"):
            weight, factor = (np.log10(x) for x in model.backoff(history, sums))
        out = []
        for row, a, b in zip(rows, bounds, bounds[1:]):
            own = at[a:b][_load(row["needed"], bool)]
            if len(own):
                out.append((row["chunk"], row["part"], _dump(weight[own]), _dump(factor[own])))
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        columns = zip(*out) if out else [[]] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=_names(_WEIGHTS))

    return weigh


_RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _finish(key, scored: pa.Table, weights: pa.Table) -> pa.Table:
    row = scored.to_pylist()[0]
    docs, words = _load(row["docs"], np.uint32), _load(row["words"], np.uint32)
    told = sorted(weights.to_pylist(), key=lambda r: r["part"])
    values = _load(row["values"], np.float64).reshape(5, -1)
    score = values[3].copy()
    if len(docs):
        weight = np.concatenate([_load(r["weight"], np.float64) for r in told])[words]
        factor = np.concatenate([_load(r["factor"], np.float64) for r in told])[words]
        score += np.bincount(
            docs, _load(row["unseen"], np.uint32) * weight + _load(row["seen"], np.uint32) * factor, len(score)
        )
    columns = [
        pa.array(row["ids"], pa.int64()),
        pa.array(values[4] > 0),
        pa.array(values[0].astype(np.int64)),
        pa.array(values[1].astype(np.int64)),
        pa.array(values[2]),
        pa.array(score),
    ]
    return pa.table(columns, names=_names(_RESULT))


def katz_scores(docs: DataFrame, chunk_tokens: int = 4_000_000, part_keys: int = 2_000_000) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text) by a model of those outside the held-out fold.

    doc_id, held_out (crc32 of the doc_id as text, mod 7, is 2), n_tokens (words and one end), n_known (tokens
    that training has), train_tokens, base_score (add-one unigrams) and score, the model's log10
    probability of the text. A null text is empty and has its end token alone; a null doc_id counts
    as the empty text for the fold. Rows that occur twice are learned and scored twice. Without any
    training row every token is unknown. No rows give no rows. Words and pairs are told apart by
    64-bit hashes. ``chunk_tokens`` and ``part_keys`` bound what a task holds.
    """
    chunks = stored(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_chunker(chunk_tokens), _CHUNKS),
        "katz-chunks",
    )
    tokens, trained = chunks.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("trained"), F.lit(0))).first()
    parts = max(1, -(-tokens // part_keys))
    spread = max(shuffle_partitions(docs.sparkSession), 2 * parts)
    asked = chunks.mapInArrow(_asker(parts), _ASKED).repartition(spread, "level", "part")
    told = stored(asked.groupBy("level", "part").applyInArrow(_count, _TOLD), "katz-counts")
    width = CUTOFF + 3
    sums = told.filter("stats IS NOT NULL").groupBy("level").agg(*(F.sum(F.get("stats", F.lit(i))) for i in range(width)))
    stats = {r[0]: list(r[1:]) for r in sums.collect()}
    model = Model(stats.get(1, [0] * width), stats.get(2, [0] * width), trained)
    told = told.select("chunk", "level", "part", "totals", "owned")
    scored = stored(
        chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_scorer(model, parts), _SCORED), "katz-scored"
    )
    weights = (
        scored.filter("part IS NOT NULL")
        .select("chunk", "part", "keys", "sums", "needed")
        .groupBy("part")
        .applyInArrow(_weigher(model), _WEIGHTS)
    )
    final = scored.filter("part IS NULL").select("chunk", "docs", "words", "unseen", "seen", "ids", "values")
    result = final.groupBy("chunk").cogroup(weights.groupBy("chunk")).applyInArrow(_finish, _RESULT)
    return result.withColumn("train_tokens", F.lit(model.tokens).cast("bigint"))
