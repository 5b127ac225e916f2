"""Tokenizer alignment, hard negatives and exact duplicates against plain versions."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import llm_brute as brute
from barlake.llm import exact_dedup
from barlake.llm.alignment import ByteBpe, align_tokenizers
from barlake.llm.exact_dedup import drop_exact_duplicates, exact_duplicates, golomb_decode, golomb_encode, golomb_parameter
from barlake.llm.hard_negatives import field_bits, first_in_windows, hard_negatives, products

ODD = [(7001, "tail \n two"), (7002, "tail two"), (7003, "tail  two "), (7004, " \t"), (7005, "\n"), (None, "tail two")]
ROWS = brute.documents() + ODD


def same(got, wanted):
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


# --------------------------------------------------------------------------
# Exact duplicates


@given(st.lists(st.integers(0, 10**6)), st.integers(1, 10**5))
@settings(max_examples=200, deadline=None)
def test_golomb_code_round_trip(gaps, parameter):
    assert golomb_decode(golomb_encode(np.array(gaps, dtype=np.uint64), parameter)).tolist() == gaps


def test_golomb_code_is_near_the_entropy():
    gaps = np.random.default_rng(1).geometric(1 / 1000, 20_000) - 1
    size = 8 * len(golomb_encode(gaps.astype(np.uint64), golomb_parameter(1000))) / len(gaps)
    assert size < 1.03 * math.log2(1000 * math.e)


@pytest.mark.parametrize("owner_rows", [7, 2_000_000])
def test_exact_duplicates(spark, owner_rows):
    docs = brute.frame(spark, ROWS).repartition(5)
    got = exact_duplicates(docs, owner_rows).collect()
    wanted, groups = brute.exact_duplicates(ROWS)
    same([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], wanted)
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_texts_with_one_fingerprint_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SPARE_BITS", -4)
    got = exact_duplicates(brute.frame(spark, ROWS)).select("doc_id", "keep_id", "group_size", "text_sha256").collect()
    same(got, brute.exact_duplicates(ROWS)[0])


def test_exact_duplicates_keep_rows_and_columns(spark):
    docs = brute.frame(spark, ROWS)
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == brute.exact_duplicates(ROWS)[1]
    assert set(map(tuple, kept.select("doc_id", "text").collect())) <= set(ROWS)
    assert exact_duplicates(brute.frame(spark, [])).count() == 0


def test_one_text_in_most_rows(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i}") for i in range(3000)]
    got = exact_duplicates(spark.createDataFrame(rows, brute.SCHEMA).repartition(16))
    assert got.filter("kept").count() == 1001
    assert got.filter("group_size = 2000").agg(F.min("keep_id"), F.max("keep_id"), F.count("*")).first()[:] == (1, 1, 2000)


def test_only_suspects_are_shuffled(spark, monkeypatch):
    plans = {}
    store = exact_dedup.stored

    def watched(rows, name):
        plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return store(rows, name)

    monkeypatch.setattr(exact_dedup, "stored", watched)
    exact_duplicates(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    # Bitmaps travel to the partitions, rows do not; texts are grouped in the map tasks first.
    assert "Bucketed: true" in plans["suspects"] and plans["suspects"].count("Exchange hash") == 2
    assert plans["equal-texts"].count("partial_count") == 1


# --------------------------------------------------------------------------
# Hard negatives


@given(st.integers(0, 2**32), st.integers(1, 9), st.integers(1, 70))
@settings(max_examples=60, deadline=None)
def test_products_are_exact(seed, size, bits):
    rng = np.random.default_rng(seed)
    draw = lambda n: [[int(x) * 2 ** max(0, bits - 30) for x in row] for row in rng.integers(-(2 ** min(bits, 30)), 2 ** min(bits, 30) + 1, (n, size))]
    a, c = draw(4), draw(11)
    kind = float if bits < 53 else object
    got = products(np.array(a, dtype=kind), np.array(c, dtype=kind))
    clamp = lambda x: max(-(2**62), min(2**62, x))
    assert got.tolist() == [[clamp(sum(x * y for x, y in zip(p, q))) for q in c] for p in a]


def test_two_candidates_share_a_multiplication():
    vectors = np.floor(256 * np.random.default_rng(0).uniform(-0.6, 0.6, (500, 64)))
    assert 2 * field_bits(vectors, vectors) <= 53


def test_windows_with_wide_scores():
    scores = np.array([[2**61, 5, 5, -(2**61), 4]])
    low, high = np.array([[4, -(2**62)]]), np.array([[5, -6]])
    rows, windows, columns = first_in_windows(scores, np.ones(scores.shape, bool), low, high, 3)
    assert list(zip(windows.tolist(), columns.tolist())) == [(0, 1), (0, 2), (0, 4), (1, 3)]


VECTORS = "vec_id long, label int, vector array<float>, rid string, i string, j string, found string"


def _vectors(rng, count):
    rows = [(i, int(rng.integers(0, 4)), rng.normal(size=6).tolist()) for i in range(count)]
    rows += [(i, 1, [0.5] * 6) for i in range(1000, 1040)]  # ties
    rows += [rows[0], rows[0], rows[50], (None, 2, rows[3][2]), (100, None, rows[4][2]), (150, 1, None)]
    rows += [(2000, 1, [None] + [1.0] * 5), (2050, 1, [math.nan] * 6), (2100, 1, [math.inf] + [0.0] * 5)]
    rows += [(2150, 1, []), (2200, 2, [1.0, 2.0]), (2250, 9, [1.0] * 6)]
    return [(i, label, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, label, v in rows]


@pytest.mark.parametrize("chunks", [{}, {"chunk_anchors": 3, "chunk_rows": 40}])
def test_hard_negatives(spark, chunks):
    rows = _vectors(np.random.default_rng(5), 320)
    table = spark.createDataFrame([(*r, None, None, None, None) for r in rows], VECTORS).repartition(3)
    got = hard_negatives(table, F.col("vec_id") % 50 == 0, **chunks).collect()
    same(got, brute.hard_negatives(rows))


def test_hard_negatives_of_huge_components(spark):
    rng = np.random.default_rng(6)
    rows = [(i, i % 3, [float(np.float32(x)) for x in rng.normal(size=4) * 10.0 ** rng.integers(0, 30)]) for i in range(120)]
    got = hard_negatives(spark.createDataFrame([(*r, *"abcd") for r in rows], VECTORS), F.col("vec_id") % 10 == 0).collect()
    same(got, brute.hard_negatives(rows, every=10))


def test_no_vectors(spark):
    assert hard_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).count() == 0


# --------------------------------------------------------------------------
# Alignment


@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    merges = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    merges.encode_special_tokens = True
    return merges, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


TEXTS = [
    (8001, "<|endoftext|> <s> <0x41> <unk>"),
    (8002, "white ▁ mark"),
    (8003, "  lead\tand\r\ntrail  \n\n"),
    (8004, "日本語のテキスト and Ελληνικά 🙂🙃 नमस्ते"),
    (8005, "aaaa" * 300 + " " * 700 + "12345678901234567890" + "!?" * 50),
    (8006, "é     ﻿"),
]


@pytest.mark.parametrize("chunk_chars", [1, 5000, 1_000_000])
def test_alignment(spark, tokenizers, chunk_chars):
    rows = [r for r in ROWS if len(r[1] or "") < 20_000] + TEXTS
    aligned, counts = align_tokenizers(brute.frame(spark, rows).repartition(2), chunk_chars=chunk_chars)
    wanted, pairs = brute.alignment(rows, *tokenizers)
    same(aligned.collect(), wanted)
    top = {}
    for (a, _), n in pairs.items():
        top[a] = max(n, top.get(a, 0))
    same(counts.collect(), [(a, b, n, n == top[a]) for (a, b), n in pairs.items()])


def test_alignment_of_long_texts(spark, tokenizers):
    rows = [r for r in ROWS if len(r[1] or "") >= 20_000] + [(1, "word " * 60_000)]
    same(align_tokenizers(brute.frame(spark, rows))[0].collect(), brute.alignment(rows, *tokenizers)[0])


def test_alignment_of_nothing(spark):
    aligned, counts = align_tokenizers(brute.frame(spark, []))
    assert aligned.count() == counts.count() == 0
    aligned, counts = align_tokenizers(brute.frame(spark, [(1, None), (2, "▁")]))
    same(aligned.collect(), [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")])
    assert counts.count() == 0


def test_fast_ids_are_those_of_the_file(tokenizers):
    import public_tokenizers

    encode = ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" " + (t or "") for _, t in [*ROWS, *TEXTS]]
    assert encode(texts) == [x.ids for x in tokenizers[0].encode_batch(texts, add_special_tokens=False)]
