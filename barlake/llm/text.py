"""Words of texts as bytes and as 64-bit numbers, for code that runs in tasks.

Every word class used here is a set of bytes: characters outside ASCII are word
characters as a whole, and so are all their UTF-8 bytes. A table of 256 bytes
therefore turns a text into words parted by single blanks, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

_BLANKS = bytes([0x20, *range(0x09, 0x0E)])
_UPPER = bytes(range(0x41, 0x5B))


def _table(is_word, lower: bool) -> bytes:
    changed = bytearray(range(256))
    if lower:
        for byte in _UPPER:
            changed[byte] = byte + 32
    return bytes(byte if is_word(byte) else 0x20 for byte in changed)


#: Words ``[^\x20\x09-\x0D]+`` unchanged, and with A-Z lower-cased.
PLAIN = _table(lambda byte: byte not in _BLANKS, lower=False)
LOWER = _table(lambda byte: byte not in _BLANKS, lower=True)
#: Lower-cased words of letters, digits and characters outside ASCII.
LETTERS = _table(lambda byte: 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80, lower=True)

_SEGMENT = 1 << 22
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_UNSTEP = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_FACTORS = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {}


def _powers_of(base: np.uint64, count: int) -> np.ndarray:
    kept = _powers.get(int(base))
    if kept is None or len(kept) < count:
        kept = np.full(max(count, 1 << 16), base, dtype=np.uint64)
        kept[0] = 1
        kept = np.multiply.accumulate(kept)
        if count <= _SEGMENT * 2:
            _powers[int(base)] = kept
    return kept[:count]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits; a one-to-one map."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _hash_segment(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word = np.zeros(len(data) + 2, dtype=np.int8)
    word[1:-1] = data != 0x20
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _powers_of(_STEP, len(data)), out=sums[1:])
    raw = (sums[ends] - sums[starts]) * _powers_of(_UNSTEP, len(data))[starts]
    return starts, ends, mix(raw + (ends - starts).astype(np.uint64))


class Words:
    """Words of some documents: where each starts and ends in ``data``, and its hash.

    Words of document ``i`` are those from ``bounds[i]`` to ``bounds[i + 1]``.
    """

    def __init__(self, docs: Sequence[bytes], table: bytes):
        self.data = b"\n".join(docs).translate(table)
        data = np.frombuffer(self.data, dtype=np.uint8)
        parts, at = [], 0
        while at < len(data):
            end = min(at + _SEGMENT, len(data))
            if end < len(data):
                blank = self.data.find(b" ", end)
                end = len(data) if blank < 0 else blank
            starts, ends, hashes = _hash_segment(data[at:end])
            parts.append((starts + at, ends + at, hashes))
            at = end
        empty = np.zeros(0, dtype=np.int64)
        self.starts = np.concatenate([p[0] for p in parts]) if parts else empty
        self.ends = np.concatenate([p[1] for p in parts]) if parts else empty
        self.hashes = np.concatenate([p[2] for p in parts]) if parts else empty.astype(np.uint64)
        lengths = np.fromiter((len(d) + 1 for d in docs), dtype=np.int64, count=len(docs))
        self.bounds = np.searchsorted(self.starts, np.concatenate([[0], np.cumsum(lengths)]))

    def joined(self, first: int, last: int) -> bytes:
        """Words from ``first`` up to ``last``, joined by single blanks."""
        if first >= last:
            return b""
        return b" ".join(self.data[self.starts[first] : self.ends[last - 1]].split())


def sequence_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash of every ``size`` consecutive words, also across documents."""
    count, step = max(0, len(hashes) - size + 1), int(_STEP)
    total = np.full(count, (2 * seed + 1) * step % 2**64, dtype=np.uint64)
    for i in range(size):
        factor = int(_FACTORS[i % len(_FACTORS)]) + 2 * (i // len(_FACTORS))
        if seed:
            factor *= 2 * seed * step + 1
        total += hashes[i : i + count] * np.uint64(factor % 2**64)
    return mix(total)


def range_hashes(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of the words from each start up to its stop, at a cost that does not depend on their number."""
    if not len(starts):
        return hashes[:0]
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _powers_of(_STEP, len(hashes)), out=sums[1:])
    return mix((sums[stops] - sums[starts]) * _powers_of(_UNSTEP, len(hashes))[starts] + (stops - starts).astype(np.uint64))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(column).cast(pa.binary()).to_pylist()


def groups_by_size(texts: Sequence[bytes | None], limit: int = 1 << 20) -> Iterator[range]:
    """Consecutive ranges of texts with about ``limit`` bytes, one text at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= limit:
            yield range(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield range(start, len(texts))
