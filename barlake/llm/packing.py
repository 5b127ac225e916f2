"""Packing documents into training sequences by bin completion.

Token counts come from a public tokenizer. Pieces are dealt into groups of bounded size
and each group is packed by branch and bound: the largest piece left opens a sequence,
all undominated fillings of the rest of the sequence are tried in the order of the waste they leave, and a
branch ends when its waste can no longer beat the best packing known: at first best-fit decreasing, or a single way down the tree
that best-fit finishes where effort ends. Only the effort of the search is bounded: when it is used up, the best packing known so far stays.
"""

from __future__ import annotations

import math
import os
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .storage import stored
from .text import groups_by_size, texts_of

CAPACITY = 2048

# --------------------------------------------------------------------------
# Token ids

#: A word that the tokenizer splits into its letters, lower-cased, and its punctuation. Other
#: words are given to the tokenizer as they are.
_SIMPLE = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"
_WORD_END = "</w>"


class TokenIds:
    """Ids of texts by a word-end BPE tokenizer, which treats words between blanks alone.

    Arrow splits the texts and numbers their distinct words; each distinct run of letters or marks is given to the
    tokenizer once. The store of runs is emptied when it holds ``limit`` of them.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        size = self._tokenizer.get_vocab_size()
        self._ends = np.array([(self._tokenizer.id_to_token(i) or "").endswith(_WORD_END) for i in range(size)])
        self._limit = limit
        self._known: dict[str, bytes] = {"": b""}

    def _encode(self, words: Sequence[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(list(words), add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """One call for all: every piece ends with the one token that ends a word."""
        joined = self._tokenizer.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0]
        ids = np.array(joined.ids, dtype="<u4")
        stops = ((np.flatnonzero(self._ends[ids]) + 1) * 4).tolist()
        if len(stops) != len(pieces):
            return self._encode(pieces)
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *stops], stops)]

    def _ids(self, runs: pa.Array, encode: Callable[[list[str]], list[bytes]]) -> pa.Array:
        """Ids of each run as bytes. A run of marks has the same ids alone and after letters, so that one store serves all."""
        coded = runs.dictionary_encode()
        distinct = [x.decode("utf-8", "replace") for x in coded.dictionary.view(pa.large_binary()).to_pylist()]
        if len(self._known) + len(distinct) > self._limit:
            self._known = {"": b""}
        new = list({x for x in distinct if x not in self._known})
        if new:
            self._known.update(zip(new, encode(new)))
        return pa.array([self._known[x] for x in distinct], pa.large_binary()).take(coded.indices)

    def _ids_of_words(self, words: pa.Array) -> pa.Array:
        parts = pc.extract_regex(words, _SIMPLE)
        letters = pc.utf8_lower(pc.fill_null(pc.struct_field(parts, "letters"), ""))
        ids = [self._ids(x, self._encode_pieces) for x in (letters, pc.fill_null(pc.struct_field(parts, "marks"), ""))]
        ids = pc.binary_join_element_wise(*ids, pa.scalar(b"", pa.large_binary()))
        others = pc.is_null(parts)
        if pc.any(others).as_py():
            ids = pc.replace_with_mask(ids, others, self._ids(words.filter(others), self._encode))
        return ids

    def __call__(self, texts: Sequence[bytes]) -> list[np.ndarray]:
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string()))
        words = lists.flatten().dictionary_encode()
        if not len(words):
            return [np.empty(0, "<u4") for _ in texts]
        ids = self._ids_of_words(words.dictionary).take(words.indices)
        stops = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1] // 4
        stops = stops[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        data = np.frombuffer(ids.buffers()[2] or b"", dtype="<u4")
        return [data[a:b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist())]


_loaded: dict[str, TokenIds] = {}


def _token_ids(path: str) -> TokenIds:
    if path not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _loaded[path] = TokenIds(path)
    return _loaded[path]


def _cutter(tokenizer: Callable[[], str], capacity: int, end_id: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _token_ids(tokenizer())
        for batch in batches:
            texts, docs = texts_of(batch), batch.column("doc_id").to_pylist()
            for part in groups_by_size(texts):
                rows = []
                for i, ids in zip(part, encode([texts[i] or b"" for i in part])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        own = ids[start : start + capacity]
                        rows.append((docs[i], piece, start, len(own), zlib.crc32(own.tobytes()), own))
                columns = list(zip(*rows))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([x.astype(np.int32) for x in columns[5]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return cut


# --------------------------------------------------------------------------
# Bin completion


def lower_bound(counts: Counter, capacity: int) -> int:
    """Sequences any packing needs: by volume, and with pieces too large to share (Martello and Toth's L2)."""
    sizes = sorted(counts)
    best = -(-sum(s * n for s, n in counts.items()) // capacity)
    for small in [0, *(s for s in sizes if 2 * s <= capacity)]:
        alone = sum(n for s, n in counts.items() if s > capacity - small)
        halves = [(s, n) for s, n in counts.items() if capacity - small >= s and 2 * s > capacity]
        rest = sum(s * n for s, n in counts.items() if small <= s and 2 * s <= capacity)
        room = sum((capacity - s) * n for s, n in halves)
        best = max(best, alone + sum(n for _, n in halves) + max(0, -(-(rest - room) // capacity)))
    return best


def best_fit_decreasing(counts: Counter, capacity: int) -> list[list[int]]:
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has r left
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            fits = rooms >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                at = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
                bins[at].append(size)
            else:
                room, at = capacity, len(bins)
                bins.append([size])
            by_room[room - size].append(at)
            rooms |= 1 << (room - size)
    return bins


class _Left:
    """Pieces not yet placed: counts by size, and the sizes at hand as bits, upwards and downwards.

    ``effort`` is the number of sums that may still be looked for; adding four sizes to the
    sums of all pieces takes about as long and counts as one.
    """

    def __init__(self, counts: Counter, capacity: int, effort: int):
        self.capacity = capacity
        self.effort = effort
        self.counts = [0] * (capacity + 1)
        self.up = self.down = 0
        self._owner: object | None = None
        for size, n in counts.items():
            self.add(size, n)

    def add(self, size: int, n: int = 1) -> None:
        self.counts[size] += n
        self.up |= 1 << size
        self.down |= 1 << (self.capacity - size)

    def take(self, size: int) -> None:
        self.counts[size] -= 1
        if not self.counts[size]:
            self.up &= ~(1 << size)
            self.down &= ~(1 << (self.capacity - size))

    def largest(self, room: int) -> int:
        return (self.up & ((1 << (room + 1)) - 1)).bit_length() - 1 if room > 0 else -1

    def pairs(self, total: int) -> Iterator[tuple[int, int]]:
        self.effort -= 1
        both = self.up & (self.down >> (self.capacity - total))
        both &= (1 << (total // 2 + 1)) - 1
        while both:
            small = both.bit_length() - 1
            both &= ~(1 << small)
            if 2 * small != total or self.counts[small] > 1:
                yield total - small, small

    def triples(self, total: int) -> Iterator[tuple[int, int, int]]:
        least = (self.up & -self.up).bit_length() - 1
        bits = self.up & ((1 << (total // 3 + 1)) - 1)
        bits &= -1 << max(0, total - 2 * self.largest(total - 2 * least))
        while bits and self.effort > 0:
            third = (bits & -bits).bit_length() - 1
            bits &= bits - 1
            for large, small in self.pairs(total - third):
                if small < third:
                    break
                if small > third or self.counts[third] > 1 + (large == third):
                    yield large, small, third

    def _sums(self, room: int, owner: object) -> tuple[list[int], list[int]]:
        """Sizes up to ``room``, and as bits the sums of pieces of the first 0, 1, 2, ... of them.

        Kept for one owner at a time, as every open sequence would need its own.
        """
        if self._owner is not owner:
            sizes, sums, mask = [], [1], (1 << (room + 1)) - 1
            bits = self.up & mask
            while bits:
                size = (bits & -bits).bit_length() - 1
                bits &= bits - 1
                new, n, copies = sums[-1], min(self.counts[size], room // size), 1
                while n:
                    copies = min(copies, n)
                    new |= new << (copies * size)
                    n -= copies
                    copies *= 2
                sizes.append(size)
                sums.append(new & mask)
            self.effort -= 1 + len(sizes) // 4
            self._owner, self._known = owner, (sizes, sums)
        return self._known

    def many(self, room: int, owner: object, total: int, least: int, first: int | None = None) -> Iterator[tuple[int, ...]]:
        """All fillings of volume ``total`` with ``least`` pieces or more, of the ``first`` smallest sizes."""
        if not total:
            if least <= 0:
                yield ()
            return
        sizes, sums = self._sums(room, owner)
        at = bisect_right(sizes, total, hi=first)
        while self.effort > 0 and sums[at] >> total & 1:
            self.effort -= 1
            at -= 1
            for n in range(min(self.counts[sizes[at]], total // sizes[at]), 0, -1):
                rest = total - n * sizes[at]
                if sums[at] >> rest & 1:
                    for others in self.many(room, owner, rest, least - n, at):
                        yield (sizes[at],) * n + others
                    sizes, sums = self._sums(room, owner)

    def dominated(self, filling: tuple[int, ...], slack: int) -> bool:
        """Whether a piece at hand could be added, or take the place of one or two pieces and waste no more."""
        if not slack and len(filling) == 2:
            return False
        used = Counter(filling)
        self.effort -= 4 + len(used) ** 2
        free = self.up
        for size, n in used.items():
            if n == self.counts[size]:
                free &= ~(1 << size)
        if free & ((1 << (slack + 1)) - 1):
            return True
        if slack and any(free >> (s + 1) & ((1 << slack) - 1) for s in used):
            return True
        two = {a + b for a in used for b in used if a > b} | {2 * a for a, n in used.items() if n > 1}
        return any(free >> s & ((1 << (slack + 1)) - 1) for s in two)

    def few(self, room: int, waste: int, one: int) -> Iterator[tuple[int, ...]]:
        """Fillings of up to three pieces; the search adds smaller ones that still fit."""
        least = (self.up & -self.up).bit_length() - 1
        for total in range(room, max(one, room - waste - 1, 2 * least - 1), -1):
            if self.effort <= 0:
                return
            yield from self.pairs(total)
            if total >= 3 * least:
                yield from self.triples(total)
        if room - one <= waste or self.up & ((1 << (room - one + 1)) - 1):
            yield (one,)

    def all(self, room: int, waste: int, one: int) -> Iterator[tuple[int, ...]]:
        """All undominated fillings, of any number of pieces, while effort lasts."""
        owner, total = object(), room
        while total > max(one, room - waste - 1) and self.effort > 0:
            for filling in chain(self.pairs(total), self.triples(total), self.many(room, owner, total, 4)):
                if not self.dominated(filling, room - total):
                    yield filling
            total = (self._sums(room, owner)[1][-1] & ((1 << total) - 1)).bit_length() - 1
        if self.effort > 0 and room - one <= waste and not self.dominated((one,), room - one):
            yield (one,)

    def fillings(self, room: int, waste: int, whole: bool) -> Iterator[tuple[int, ...]]:
        """Fillings of ``room`` by falling volume, without those that a single piece dominates.

        A piece of size y takes the place of any filling of volume y or less, so only the
        largest piece that fits and fillings of more volume are worth a try. None of
        the fillings leaves more than ``waste``.
        """
        one = self.largest(room)
        if one == room:
            yield (one,)
        elif one >= 0:
            yield from (self.all if whole else self.few)(room, waste, one)
        elif room <= waste:
            yield ()


def _classes(counts: Counter, capacity: int) -> Iterator[tuple[int, list[int], int]]:
    """Classes of pieces of which ``k`` fill a sequence badly and ``k + 1`` of the smaller ones fill it well.

    Taking the largest piece with the smallest ones wastes the latter there; the larger pieces of the class should go ``k`` to a
    sequence. Each class has ``k``, its sizes upwards, and a first guess where the larger ones begin: up to there
    the mean is ``capacity / (k + 1)``.
    """
    sizes = np.repeat(sorted(counts), [counts[s] for s in sorted(counts)])
    for k in (2, 3, 4):
        low, high = np.searchsorted(sizes, [capacity // (k + 2) + 1, capacity // k], side="right")
        own = sizes[low:high]
        if len(own) > k and own[0] * (k + 1) <= capacity < own[-1] * (k + 1):
            means = np.cumsum(own) / np.arange(1, len(own) + 1)
            yield k, own.tolist(), int(np.searchsorted(means, capacity / (k + 1), side="right"))


def _dive(counts: Counter, capacity: int, effort: int) -> tuple[list[list[int]], int]:
    """A packing by one way down the tree: each sequence takes its first filling; best-fit places what effort leaves."""
    left = _Left(counts, capacity, effort)
    bins: list[list[int]] = []
    while left.up and left.effort > 0:
        first = left.largest(capacity)
        left.take(first)
        own = [first]
        room = capacity - first
        for size in next(left.fillings(room, room, False), ()):
            left.take(size)
            own.append(size)
            room -= size
        while (more := left.largest(room)) >= 0:
            left.take(more)
            own.append(more)
            room -= more
        bins.append(own)
    rest = Counter({size: n for size, n in enumerate(left.counts) if n})
    return bins + best_fit_decreasing(rest, capacity), left.effort


def _clustered_dive(
    counts: Counter, capacity: int, effort: int, pieces: Sequence[int], k: int
) -> tuple[list[list[int]], int]:
    """A dive in which ``pieces``, sorted, go ``k`` to a sequence; smaller pieces can still join them."""
    own, names = counts.copy(), {}
    for i in range(len(pieces) % k, len(pieces), k):
        together = pieces[i : i + k]
        own.subtract(together)
        names.setdefault(sum(together), []).append(list(together))
    own = +own
    own.update({size: len(found) for size, found in names.items()})
    bins, effort = _dive(own, capacity, effort)
    return [[x for size in b for x in (names[size].pop() if names.get(size) else [size])] for b in bins], effort


def _incumbent(counts: Counter, capacity: int, effort: int, bound: int) -> list[list[int]]:
    """The best of best-fit decreasing and of dives with and without clusters of large pieces."""
    best = best_fit_decreasing(counts, capacity)
    if len(best) <= bound:
        return best
    found, left = _dive(counts, capacity, effort // 4)
    effort -= effort // 4 - max(0, left)
    best = min(best, found, key=len)
    classes = list(_classes(counts, capacity))
    for number, (k, sizes, cut) in enumerate(classes):
        share = effort // (len(classes) - number)
        tried: dict[int, int] = {}
        step = len(sizes) // 8
        while step and share > 0 and len(best) > bound:
            for at in (cut, cut - step, cut + step):
                if at in tried or not 0 <= at <= len(sizes) - k or share <= 0:
                    continue
                found, left = _clustered_dive(counts, capacity, share // 2 + 1, sizes[at:], k)
                spent = share // 2 + 1 - max(0, left)
                share, effort = share - spent, effort - spent
                tried[at] = len(found)
                best = min(best, found, key=len)
            if not tried:
                break
            nearest = min(tried, key=tried.get)
            step, cut = (step // 2, nearest) if nearest == cut else (step, nearest)
    return best


def bin_completion(counts: Counter, capacity: int, effort: int = 1_000_000) -> list[list[int]]:
    """Sequences as lists of sizes. ``effort`` bounds the search for fillings, not the pieces placed.

    Half of it at most goes to first packings, a quarter to fillings of few pieces, which keep small pieces for
    later; the rest to all fillings. A search that effort interrupts leaves the best packing known. The result is optimal if effort is left.
    """
    bound = lower_bound(counts, capacity)
    best = _incumbent(counts, capacity, effort // 2, bound)
    total = sum(s * n for s, n in counts.items())
    effort -= effort // 2
    kept = effort // 2
    for whole in (False, True):
        effort = effort + kept if whole else effort - kept
        while len(best) > bound and effort > 0:
            better, effort = _search(counts, capacity, (len(best) - 1) * capacity - total, effort, whole)
            if better is None:
                break
            best = better
    return best


def _search(
    counts: Counter, capacity: int, waste: int, effort: int, whole: bool
) -> tuple[list[list[int]] | None, int]:
    """A packing that wastes at most ``waste``, or None if the effort is used up or, with ``whole``, if there is none."""
    left = _Left(counts, capacity, effort)
    path: list[tuple[int, Iterator, tuple[int, ...] | None, int]] = []
    spent = 0

    def open_bin() -> None:
        first = left.largest(capacity)
        left.take(first)
        path.append((first, left.fillings(capacity - first, waste - spent, whole), None, 0))

    if not left.up:
        return [], effort
    open_bin()
    while path:
        first, choices, chosen, lost = path.pop()
        if chosen is not None:
            for size in chosen:
                left.add(size)
            spent -= lost
        left.effort -= 1
        chosen = next(choices, None)
        if left.effort <= 0:
            return None, 0
        if chosen is None:
            left.add(first)
            continue
        lost = capacity - first - sum(chosen)
        for size in chosen:
            left.take(size)
        while (more := left.largest(lost)) >= 0:
            left.take(more)
            chosen += (more,)
            lost -= more
        spent += lost
        if spent > waste:
            path.append((first, choices, chosen, lost))
            continue
        path.append((first, choices, chosen, lost))
        if not left.up:
            return [[size, *filling] for size, _, filling, _ in path], left.effort
        open_bin()
    return None, left.effort


def _packer(capacity: int):
    def pack(group: pa.Table) -> pa.Table:
        lengths = group.column("length").to_numpy()
        rows: dict[int, list[int]] = {}
        for row in np.lexsort((group.column("piece").to_numpy(), group.column("ids_crc32").to_numpy()))[::-1].tolist():
            rows.setdefault(int(lengths[row]), []).append(row)
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        first = group.column("group")[0].as_py() << 32
        for number, sizes in enumerate(bin_completion(Counter(lengths.tolist()), capacity)):
            at = 0
            for size in sizes:
                row = rows[size].pop()
                sequence[row], offset[row] = first + number, at
                at += size
        out = group.drop_columns(["group"])
        return out.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return pack


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: Callable[[], str] = default_tokenizer,
    end_id: int = 0,
    group_pieces: int = 16_384,
    with_ids: bool = False,
) -> DataFrame:
    """Placement of every document of ``docs`` (doc_id, text) in sequences of ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the ids if
    ``with_ids``. A document is its ids and ``end_id``; only longer ones are cut. A null text counts as
    empty and gives a piece with ``end_id`` alone. Rows that occur twice are placed twice; a null
    doc_id is placed like others; no rows give no rows. ``tokenizer`` names the tokenizer's
    file where tasks run. Each group of about ``group_pieces`` can end with one sequence that is not full.
    """
    columns = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    if with_ids:
        columns += ", ids array<int>"
    pieces = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _cutter(tokenizer, capacity, end_id, with_ids), columns
    )
    pieces = stored(pieces, "pieces")
    groups = max(1, math.ceil(pieces.count() / group_pieces))
    # Copies have the same length; dealing by place instead of content spreads them.
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(_packer(capacity), f"{columns}, sequence_id bigint, offset bigint")
