"""Near-duplicate documents by min-max hashing.

A document is its set of distinct word shingles. Each of 70 permutations of the 64-bit shingle
hashes gives two values of its signature, the minimum and the maximum; both agree for two
sets with a probability equal to their similarity. The 140 values are cut into bands, as long as
sets at the threshold miss each other with a probability below one in a million: 28 bands of 5 at
0.85 (8e-8), 35 bands of 4 at 0.8 (1e-8).

Sets that share a band are gathered into clusters, and inside clusters all links are confirmed
on full sets: a block looks each set's shingles up in the postings of the others, which counts
all intersections exactly without naming pairs, and keeps a spanning forest. Clusters
too large for one block are cut into chunks, and blocks are made of two chunks each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import connected_components
from .storage import stored
from .text import LOWER, Words, groups_by_size, mix, sequence_hashes, texts_of

SHINGLE = 3
PERMUTATIONS = 70
PERCENT = 85
MISSED = 1e-6

_factors = np.random.default_rng(20250311).integers(0, 2**63, 2 * PERMUTATIONS, dtype=np.uint64) * np.uint64(
    2
) + np.uint64(1)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, sorted; a text with fewer words is one shingle."""
    words = Words(texts, LOWER)
    hashes = sequence_hashes(words.hashes, size)
    sets = []
    for first, last in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if last - first >= size:
            sets.append(np.unique(hashes[first : last - size + 1]))
        else:
            sets.append(sequence_hashes(words.hashes[first:last], last - first, 1) if last > first else hashes[:0])
    return sets


def min_max(shingles: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of the shingles under each permutation."""
    low = np.full(PERMUTATIONS, 2**64 - 1, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for i in range(0, len(shingles), 1 << 15):
        permuted = shingles[None, i : i + (1 << 15)] * _factors[:PERMUTATIONS, None]
        np.minimum(low, permuted.min(axis=1), out=low)
        np.maximum(high, permuted.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_rows(percent: int) -> int:
    """Values per band: as many as keep the chance to miss a pair at the threshold below MISSED."""
    miss = lambda rows: (1 - (percent / 100) ** rows) ** (2 * PERMUTATIONS // rows)
    return max((rows for rows in range(1, 2 * PERMUTATIONS) if miss(rows) < MISSED), default=1)


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    bands = signatures.shape[1] // rows
    used = signatures[:, : bands * rows]
    weighted = (used * _factors[None, : bands * rows]).reshape(len(signatures), bands, rows)
    return mix(weighted.sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)[None, :] * _factors[0])


def _signer(size: int, percent: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            for part in groups_by_size(texts):
                sets = shingle_sets([texts[i] or b"" for i in part], size)
                keys = [
                    [int(x) for x in np.add.reduce([s, mix(s)], axis=1, dtype=np.uint64).view(np.int64)] for s in sets
                ]
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                if full:
                    found = band_keys(np.stack([min_max(sets[i]) for i in full]), band_rows(percent)).view(np.int64)
                    for i, row in zip(full, found):
                        bands[i] = row
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.start, len(part)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([k[0] for k in keys], pa.int64()),
                        pa.array([k[1] for k in keys], pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands"],
                )

    return sign


# --------------------------------------------------------------------------
# Links inside a block


class Forest:
    def __init__(self, size: int):
        self.parent = list(range(size))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def unite(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)


def link_sets(sets: list[np.ndarray], left: np.ndarray, percent: int) -> Forest:
    """Forest over sets that reach ``percent``; each set is compared with those marked ``left``."""
    forest = Forest(len(sets))
    size = np.array([len(s) for s in sets])
    inside = np.flatnonzero(left)
    shingles = np.concatenate([sets[i] for i in inside] or [np.zeros(0, np.uint64)])
    owner = np.repeat(inside, size[inside])
    order = np.argsort(shingles, kind="stable")
    shingles, owner = shingles[order], owner[order]
    for i, own in enumerate(sets):
        begin = np.searchsorted(shingles, own, side="left")
        count = np.searchsorted(shingles, own, side="right") - begin
        begin, count = begin[count > 0], count[count > 0]
        stops = np.cumsum(count)
        if not len(stops):
            continue
        at = np.repeat(begin - (stops - count), count) + np.arange(stops[-1])
        common = np.bincount(owner[at], minlength=len(sets))
        for j in np.flatnonzero((100 + percent) * common >= percent * (size + size[i])).tolist():
            if j != i and common[j]:
                forest.unite(i, j)
    return forest


def _linker(size: int, percent: int):
    def link(block: pa.Table) -> pa.Table:
        texts = [t or b"" for t in block.column("text").cast(pa.binary()).to_pylist()]
        nodes = block.column("node").to_pylist()
        sets: list[np.ndarray] = []
        for part in groups_by_size(texts):
            sets.extend(shingle_sets([texts[i] for i in part], size))
        sides = block.column("chunk").to_numpy()
        forest = link_sets(sets, sides == sides.min(), percent)
        pairs = [(nodes[i], nodes[forest.root(i)]) for i in range(len(nodes))]
        pairs = [(a, b) for a, b in pairs if a != b]
        return pa.table(
            {"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())}
        )

    return link


# --------------------------------------------------------------------------


def near_duplicate_groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    chunk_docs: int = 1024,
    chunk_shingles: int = 1_000_000,
) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs`` (doc_id, text).

    Documents are linked if ``100 * |A and B| >= percent * |A or B|`` for their shingle sets;
    component_id is the smallest doc_id reachable. A text without words, or null, is linked with nothing.
    Rows with one doc_id are one document. A row without a doc_id is linked with nothing and has
    no component. ``chunk_docs`` and ``chunk_shingles`` bound what a task holds; nothing is left out.
    """
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = stored(
        named.mapInArrow(
            _signer(shingle, percent), "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, bands array<bigint>"
        ),
        "signatures",
    )
    # Equal sets are one node, named by their smallest doc_id. Here and below aggregates are stored before
    # they are joined: only between scans does adaptive execution split a hot key.
    equal = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2").agg(F.min("doc_id").alias("node"))
    equal = stored(equal, "equal")
    nodes = stored(
        signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .join(equal, ["k1", "k2"])
        .select("doc_id", "node", "n_shingles", F.when(F.col("node") == F.col("doc_id"), F.col("bands")).alias("bands")),
        "nodes",
    )
    banded = nodes.filter("bands IS NOT NULL").select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("center"), F.max("node").alias("last"))
    shared = stored(shared.filter("center < last").select("band", "center"), "shared")
    near = banded.join(shared, "band").filter("node <> center")
    clusters = stored(connected_components(near.select(F.col("node").alias("a"), F.col("center").alias("b"))), "clusters")
    links = _links(named, nodes, clusters, shingle, percent, chunk_docs, chunk_shingles)
    roots = stored(connected_components(links), "roots")
    groups = nodes.select("doc_id", "node").join(roots, "node", "left")
    groups = groups.groupBy("doc_id").agg(F.min(F.coalesce("root", "node")).alias("component_id"))
    return signed.join(groups, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _links(docs, nodes, clusters, shingle, percent, chunk_docs, chunk_shingles) -> DataFrame:
    """Confirmed links (a, b): a spanning forest of each block."""
    members = stored(nodes.filter("bands IS NOT NULL").select("node", "n_shingles").join(clusters, "node"), "members")
    weight = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"))
    chunks = F.ceil(F.greatest(F.col("n") / chunk_docs, F.col("shingles") / chunk_shingles)).cast("int")
    members = members.join(stored(weight.select("root", chunks.alias("chunks")), "weight"), "root").select(
        "node", "root", "chunks", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk")
    )
    # A set meets its own chunk once and each other chunk once.
    texts = docs.join(members, docs["doc_id"] == members["node"]).select("node", "root", "chunk", "chunks", "text")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    blocks = texts.select("*", other.alias("other")).select(
        "node", "root", "chunk", "text", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")
    )
    return blocks.groupBy("root", "i", "j").applyInArrow(_linker(shingle, percent), "a bigint, b bigint")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` with one document of each group left, the one with the smallest doc_id.

    Rows without a doc_id or without words stay.
    """
    groups = near_duplicate_groups(docs, shingle, percent)
    gone = groups.filter("component_id < doc_id").select("doc_id").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"))
    return rows.join(gone, "doc_id", "left_anti").select("row.*")
