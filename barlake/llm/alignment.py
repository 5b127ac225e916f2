"""Alignment of two tokenizers over the same texts.

Tokens of both tokenizers cover the same bytes; where tokens of both end at one byte the text is cut into groups, and
a token of one is linked with every token of the other in its group.

Texts are aligned a chunk at a time by Arrow's own operations: token lists are flattened with the index of
their document, running sums of the token lengths, restarted at each document, give the ends, an Acero hash join on
(document, end) finds the common ones, and another one on groups the links. ``Table.group_by`` counts for each chunk in how many
of its documents a pair of ids is linked. Spark merges these partial counts, finds the highest count of each id, and
sends every chunk the counts of its own pairs, so neither tokens nor links are shuffled.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .storage import stored

# --------------------------------------------------------------------------
# Tokenizers

# Fixed value: how the byte-level tokenizer parts a text before it merges.
_PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LONGEST = 400
_UNUSUAL = re.compile(r"[^\x00-ɏ‐-‧‰-⁞€]|\s{%d}" % _LONGEST)


def _unusual(text: str) -> bool:
    """Whether a text has characters whose class could differ between Unicode versions, or runs so long that the faster merge slows down."""
    return bool(_UNUSUAL.search(text)) or max(map(len, text.split()), default=0) > _LONGEST


def _byte_letters() -> dict[str, int]:
    """Byte of each letter of a byte-level vocabulary: printable bytes stand for themselves, others for 256 and up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Token ids by a byte-level BPE file; special tokens in a text are text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._exact = Tokenizer.from_file(path)
        self._exact.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = _byte_letters()
        ids = {bytes(letters[ch] for ch in token): i for token, i in model["vocab"].items()}
        merged = [model["vocab"]["".join(pair) if isinstance(pair, list) else pair.replace(" ", "")] for pair in model["merges"]]
        # Ids can stand for ranks only where merges are numbered in order.
        self._fast = None
        if merged == sorted(merged):
            self._fast = tiktoken.Encoding("bytes", pat_str=_PARTS, mergeable_ranks=ids, special_tokens={})
        self.bytes_of = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            self.bytes_of[i] = token

    def __call__(self, texts: Sequence[str]) -> list[list[int]]:
        slow = [i for i, t in enumerate(texts) if self._fast is None or _unusual(t)]
        exact = self._exact.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False) if slow else []
        found = {i: x.ids for i, x in zip(slow, exact)}
        return [found[i] if i in found else self._fast.encode_ordinary(t) for i, t in enumerate(texts)]


class Pieces:
    """Token ids by a piece model with byte fallback, which puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        name = self._model.id_to_piece
        self.bytes_of = [
            bytes([int(name(i)[3:-1], 16)]) if self._model.is_byte(i) else name(i).replace("▁", " ").encode()
            for i in range(self._model.get_piece_size())
        ]

    def __call__(self, texts: Sequence[str]) -> list[list[int]]:
        return self._model.encode(list(texts), num_threads=1)


def byte_bpe() -> ByteBpe:
    import public_tokenizers

    return ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))


def pieces() -> Pieces:
    import public_tokenizers

    return Pieces(public_tokenizers.path("piece_bpe_32k.model"))


class _Side:
    """A tokenizer and its vocabulary as Arrow arrays."""

    _known: dict[Callable, _Side] = {}

    def __init__(self, tokenizer: Callable):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.encode = tokenizer()
        self.bytes_of = pa.array(self.encode.bytes_of, pa.binary())
        self.names = pa.array([str(i) for i in range(len(self.bytes_of))])

    @classmethod
    def of(cls, tokenizer: Callable) -> _Side:
        key = (tokenizer.__module__, tokenizer.__qualname__)
        if key not in cls._known:
            cls._known[key] = cls(tokenizer)
        return cls._known[key]


# --------------------------------------------------------------------------
# One chunk


def _bytes(joined: pa.Array) -> memoryview:
    """The values of a binary array, one after the other."""
    if not len(joined):
        return memoryview(b"")
    offsets = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset : joined.offset + len(joined) + 1]
    return memoryview(joined.buffers()[2] or b"").cast("B")[offsets[0] : offsets[-1]]


def _covers(side: _Side, lists: pa.ListArray, texts: Sequence[bytes]) -> np.ndarray:
    """Whether the tokens of each text, joined, are the text."""
    tokens = side.bytes_of.take(pc.list_flatten(lists))
    joined = _bytes(tokens)
    stops = np.concatenate([[0], np.cumsum(pc.binary_length(tokens).to_numpy(), dtype=np.int64)])
    stops = stops[lists.offsets.to_numpy()]
    return np.array([joined[a:b] == text for a, b, text in zip(stops[:-1].tolist(), stops[1:].tolist(), texts)], dtype=bool)


class _Tokens:
    """Tokens of the texts of a chunk, flattened, with their document and where they end in it."""

    def __init__(self, side: _Side, lists: pa.ListArray):
        self.side, self.lists = side, lists
        self.ids = pc.list_flatten(lists)
        self.doc = pc.cast(pc.list_parent_indices(lists), pa.int64())
        lengths = pc.cast(pc.binary_length(side.bytes_of.take(self.ids)), pa.int64())
        ends = pc.cumulative_sum(lengths)
        # Sums restart where a document does.
        before = np.concatenate([[0], ends.to_numpy()])[lists.offsets.to_numpy()[:-1]]
        self.end = pc.subtract(ends, pa.array(before).take(self.doc))

    def ends(self, name: str) -> pa.Table:
        key = pc.add(pc.multiply(self.doc, pa.scalar(1 << 32)), self.end)
        return pa.table({"key": key, name: pa.array(np.arange(len(key)))})

    def cut(self, places: np.ndarray) -> None:
        """Number the groups that end at the tokens in ``places``."""
        last = np.zeros(len(self.ids), dtype=np.int64)
        last[places] = 1
        self.group = np.cumsum(last) - last
        self.stops = np.concatenate([[0], np.flatnonzero(last) + 1])
        self.sizes = np.diff(self.stops)

    def written(self) -> pa.Array:
        """Decimal ids of each group, joined by commas."""
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(self.stops, pa.int32()), self.side.names.take(self.ids)), ",")

    def counted(self, several: np.ndarray, name: str) -> pa.Table:
        """How often each id occurs in each of ``several`` groups."""
        chosen = several[self.group]
        table = pa.table({"group": self.group[chosen], name: self.ids.filter(pa.array(chosen))})
        return table.group_by(["group", name], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", name, f"n_{name}"])


def _links(a: _Tokens, b: _Tokens, doc_of: np.ndarray) -> pa.Table:
    """doc, pair, times: linked id pairs of each document. A pair is (A id << 32) + B id."""
    several = (a.sizes > 1) | (b.sizes > 1)
    single = ~several
    pair = lambda x, y: pc.add(pc.multiply(pc.cast(x, pa.int64()), pa.scalar(1 << 32)), pc.cast(y, pa.int64()))
    # Groups of one token on both sides need no join.
    ones = pa.table(
        {
            "doc": doc_of[single],
            "pair": pair(a.ids.take(pa.array(a.stops[:-1][single])), b.ids.take(pa.array(b.stops[:-1][single]))),
            "times": np.ones(int(single.sum()), dtype=np.int64),
        }
    )
    # Repeats of an id in a group are counted before the join, whose size is that of the distinct pairs.
    met = a.counted(several, "a").join(b.counted(several, "b"), "group", join_type="inner", use_threads=False)
    met = pa.table(
        {
            "doc": doc_of[met.column("group").to_numpy()],
            "pair": pair(met.column("a"), met.column("b")),
            "times": pc.multiply(met.column("n_a"), met.column("n_b")),
        }
    )
    table = pa.concat_tables([ones, met]).group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")])
    return table.rename_columns(["doc", "pair", "times"])


_ROWS = pa.schema(
    [
        ("chunk", pa.int64()),
        ("is_doc", pa.bool_()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        ("pairs", pa.list_(pa.int64())),
        ("times", pa.list_(pa.int64())),
    ]
)
_ROWS_DDL = (
    "chunk bigint, is_doc boolean, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, pairs array<bigint>, times array<bigint>"
)


def _align(side_a: _Side, side_b: _Side, docs: list, texts: list[str], chunk: int) -> pa.Table:
    """A row for each document, with the numbers and times of its pairs, and one with the chunk's pairs and document counts."""
    spaced = [" " + t for t in texts]
    data = [t.encode() for t in spaced]
    lists = [
        pa.array(ids, pa.list_(pa.int32())) for ids in (side_a.encode(spaced), side_b.encode(texts))
    ]
    whole = _covers(side_a, lists[0], data) & _covers(side_b, lists[1], data) & np.array([bool(t) for t in texts])
    a, b = (_Tokens(side, x.filter(pa.array(whole))) for side, x in zip((side_a, side_b), lists))
    count = int(whole.sum())
    common = a.ends("at_a").join(b.ends("at_b"), "key", join_type="inner", use_threads=False)
    a.cut(common.column("at_a").to_numpy())
    b.cut(common.column("at_b").to_numpy())
    doc_of = a.doc.to_numpy()[a.stops[1:] - 1]
    n_groups = np.bincount(doc_of, minlength=count)
    n_links = np.bincount(doc_of, weights=(a.sizes * b.sizes).astype(np.float64), minlength=count).astype(np.int64)
    written = pc.binary_join_element_wise(a.written(), b.written(), "|")
    stops = pa.array(np.concatenate([[0], np.cumsum(n_groups)]), pa.int32())
    groups = pc.binary_join(pa.ListArray.from_arrays(stops, written), ";").to_pylist()

    links = _links(a, b, doc_of)
    counted = links.group_by("pair", use_threads=False).aggregate([("doc", "count")])
    numbers = pc.index_in(links.column("pair"), value_set=counted.column("pair").combine_chunks())
    order = np.argsort(links.column("doc").to_numpy(), kind="stable")
    per_doc = np.bincount(links.column("doc").to_numpy(), minlength=count)

    place = np.flatnonzero(whole)
    offsets = np.zeros(len(docs) + 1, dtype=np.int64)
    offsets[place + 1] = per_doc
    offsets = pa.array(np.cumsum(offsets), pa.int32())

    def spread(values: np.ndarray) -> pa.Array:
        out = np.zeros(len(docs), dtype=np.int64)
        out[place] = values
        return pa.array(out)

    hashes = [""] * len(docs)
    for at, text in zip(place.tolist(), groups):
        hashes[at] = hashlib.sha256(text.encode()).hexdigest()
    listed = lambda values: pa.ListArray.from_arrays(
        offsets, pc.cast(pa.array(values.to_numpy()[order]), pa.int64())
    )
    rows = pa.table(
        [
            pa.array([chunk] * len(docs), pa.int64()),
            pa.array([True] * len(docs)),
            pa.array(docs, pa.int64()),
            *(spread(pc.list_value_length(x.lists).to_numpy()) for x in (a, b)),
            spread(n_groups),
            spread(n_links),
            pa.array(hashes),
            listed(numbers),
            listed(links.column("times")),
        ],
        schema=_ROWS,
    )
    own = {"chunk": [chunk], "is_doc": [False]}
    own |= {f.name: [None] for f in _ROWS if f.name not in ("chunk", "is_doc", "pairs", "times")}
    own |= {"pairs": [counted.column("pair").to_pylist()], "times": [counted.column("doc_count").to_pylist()]}
    return pa.concat_tables([rows, pa.table(own, schema=_ROWS)])


def _aligner(tokenizer_a: Callable, tokenizer_b: Callable, chunk_chars: int):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _Side.of(tokenizer_a), _Side.of(tokenizer_b)
        chunk = TaskContext.get().partitionId() << 32
        docs, texts, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                docs.append(doc)
                texts.append(text or "")
                size += len(texts[-1])
                if size >= chunk_chars:
                    yield from _align(*sides, docs, texts, chunk).to_batches()
                    docs, texts, size, chunk = [], [], 0, chunk + 1
        if docs:
            yield from _align(*sides, docs, texts, chunk).to_batches()

    return align


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("n_best", pa.int64()),
        ("count_sum", pa.int64()),
        ("groups_sha256", pa.string()),
    ]
)
_RESULT_DDL = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def _summed(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of each document of a chunk, from the corpus-wide counts of the chunk's pairs."""
    order = pc.sort_indices(counts.column("number"))
    numbers = rows.column("pairs").combine_chunks()
    flat, doc = pc.list_flatten(numbers), pc.list_parent_indices(numbers)
    times = pc.list_flatten(rows.column("times").combine_chunks())
    best = pc.cast(counts.column("best").take(order).take(flat), pa.int64())
    weighed = pa.table(
        {
            "doc": doc,
            "n_best": pc.multiply(best, times),
            "count_sum": pc.multiply(counts.column("n").take(order).take(flat), times),
        }
    )
    sums = weighed.group_by("doc", use_threads=False).aggregate([("n_best", "sum"), ("count_sum", "sum")])
    at = sums.column("doc").to_numpy()
    columns = {f.name: rows.column(f.name) for f in _RESULT if f.name not in ("n_best", "count_sum")}
    for name in ("n_best", "count_sum"):
        out = np.zeros(len(rows), dtype=np.int64)
        out[at] = sums.column(f"{name}_sum").to_numpy()
        columns[name] = pa.array(out)
    return pa.table([columns[f.name] for f in _RESULT], schema=_RESULT)


# --------------------------------------------------------------------------


def align_tokenizers(
    docs: DataFrame,
    tokenizer_a: Callable = byte_bpe,
    tokenizer_b: Callable = pieces,
    chunk_chars: int = 1_000_000,
) -> tuple[DataFrame, DataFrame]:
    """Two tables: a row for every row of ``docs`` (doc_id, text), and the counts of linked id pairs.

    The first has doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256, the second a, b, n (documents that
    hold the pair linked) and best (no other b has a higher n with this a). ``tokenizer_a`` and ``tokenizer_b`` are
    module-level functions that make a tokenizer, an object with ``bytes_of`` each id that encodes a list of texts; the
    first gets a space before each text, the second adds one.

    A text that is null, empty, or not covered byte by byte by both tokenizers has no tokens: zeros, an empty string and no
    part in the counts. Every row counts as a document, also those with a null or repeated doc_id. An empty table gives
    empty tables. Other columns are ignored. A chunk ends with the text that fills ``chunk_chars`` characters, so one
    longer text is a chunk of its own.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = stored(rows.mapInArrow(_aligner(tokenizer_a, tokenizer_b, chunk_chars), _ROWS_DDL), "aligned")
    pair_of = rows.filter("NOT is_doc").select("chunk", F.posexplode(F.arrays_zip("pairs", "times")).alias("number", "own"))
    pair_of = pair_of.select("chunk", "number", F.col("own.pairs").alias("pair"), F.col("own.times").alias("times"))
    counts = pair_of.groupBy("pair").agg(F.sum("times").alias("n"))
    counts = stored(counts.withColumn("a", F.shiftright("pair", 32).cast("int")), "pair-counts")
    # One row per id of the first vocabulary.
    highest = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("highest")))
    counts = counts.join(highest, "a").select("pair", "a", "n", (F.col("n") == F.col("highest")).alias("best"))
    counts = stored(counts, "pair-best")
    back = pair_of.select(F.col("chunk").alias("to"), "number", "pair").join(counts.select("pair", "n", "best"), "pair")
    aligned = rows.filter("is_doc").groupBy("chunk").cogroup(back.drop("pair").groupBy("to")).applyInArrow(_summed, _RESULT_DDL)
    named = counts.select("a", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"), "n", "best")
    return stored(aligned, "alignment"), named
