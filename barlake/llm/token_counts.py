"""Token counts of a unigram tokenizer by dynamic programming over a trie of pre-tokens.

The best segmentation of a prefix does not depend on what follows. Distinct pre-tokens of a task are
inserted in a trie whose nodes hold the forward score of their prefix and the tokens of its best
segmentation; a prefix that many pre-tokens share is scored once. The end of each pre-token stores its
count, and a document's count is the sum over its words: no text or word is shuffled.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import groups_by_size, texts_of

SPACE = "▁".encode()


class PieceTrie:
    """Scores of pre-tokens under ``pieces`` (bytes to log probability).

    A byte that no piece covers is a token with score ``unknown``. Of segmentations with equal
    scores the one with fewer tokens counts. ``limit`` bounds the nodes; a full trie starts anew.
    """

    def __init__(self, pieces: Mapping[bytes, float], unknown: float, limit: int = 1_000_000):
        self._pieces, self._unknown, self._limit = dict(pieces), unknown, limit
        self._longest = max(map(len, self._pieces), default=1)
        self._clear()

    def _clear(self) -> None:
        self._next: dict[int, int] = {}
        self._score, self._tokens = array("d", [0.0]), array("l", [0])
        self.counts: dict[bytes, int] = {}
        self.scores: dict[bytes, float] = {}

    def learn(self, words: set[bytes]) -> None:
        """Insert words not seen before, so that ``counts`` and ``scores`` hold all of ``words``."""
        new = words - self.counts.keys()
        if len(self._score) > self._limit:
            self._clear()
            new = words
        for word in sorted(new):
            self._insert(word)

    def _insert(self, word: bytes) -> None:
        text, node, path = SPACE + word, 0, [0]
        following, pieces, score = self._next, self._pieces, self._score
        for i, byte in enumerate(text):
            edge = node << 8 | byte
            node = following.get(edge, -1)
            if node < 0:
                node = following[edge] = len(score)
                stop = i + 1
                best = score[path[i]] + self._unknown
                tokens = self._tokens[path[i]] + 1
                for start in range(max(0, stop - self._longest), stop):
                    value = pieces.get(text[start:stop])
                    if value is not None:
                        value += score[path[start]]
                        used = self._tokens[path[start]] + 1
                        if value > best or (value == best and used < tokens):
                            best, tokens = value, used
                score.append(best)
                self._tokens.append(tokens)
            path.append(node)
        self.counts[word], self.scores[word] = self._tokens[node], score[node]


def zipf_pieces() -> tuple[dict[bytes, float], float]:
    """The pieces of the public 32k vocabulary with log probabilities by rank, and that of an uncovered byte.

    The file orders pieces by merges and has no probabilities; the law 1 / (rank + 2.7) gives them.
    """
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    names = [
        model.id_to_piece(i).encode()
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = math.log(sum(1 / (rank + 2.7) for rank in range(len(names))))
    pieces = {name: -math.log(rank + 2.7) - total for rank, name in enumerate(names)}
    return pieces, min(pieces.values()) - 10


_tries: dict[Callable, PieceTrie] = {}


def _counter(vocabulary: Callable[[], tuple[dict[bytes, float], float]]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _tries:
            _tries[vocabulary] = PieceTrie(*vocabulary())
        trie = _tries[vocabulary]
        for batch in batches:
            texts = texts_of(batch)
            for part in groups_by_size(texts):
                words = [(texts[i] or b"").split() for i in part]
                trie.learn(set().union(*words))
                tokens, scores = trie.counts.__getitem__, trie.scores.__getitem__
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(part.start, len(part)),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array([sum(map(tokens, w)) for w in words], pa.int64()),
                        pa.array([math.fsum(map(scores, w)) for w in words], pa.float64()),
                    ],
                    names=["doc_id", "n_words", "n_tokens", "log_prob"],
                )

    return count


def token_counts(
    docs: DataFrame, vocabulary: Callable[[], tuple[dict[bytes, float], float]] = zipf_pieces
) -> DataFrame:
    """doc_id, n_words, n_tokens and log_prob for every row of ``docs`` (doc_id, text).

    Words are parted by ASCII white space and marked at their start, as the vocabulary does. n_tokens is the
    length of the most probable segmentation, log_prob its natural logarithm. A null or
    empty text has no tokens. Every row counts by itself, also repeated ones and those without an id.
    ``vocabulary`` is called where tasks run and gives the pieces and the score of an uncovered byte.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_counter(vocabulary), "doc_id bigint, n_words bigint, n_tokens bigint, log_prob double")
