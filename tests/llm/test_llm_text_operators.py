import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_brute as brute
from barlake.llm.decontaminate import contaminated, drop_contaminated, find_contamination, hit_words
from barlake.llm.katz import good_turing, katz_scores
from barlake.llm.line_dedup import drop_repeated_lines, line_dedup_report
from barlake.llm.near_dup import band_rows, drop_near_duplicates, min_max, near_duplicate_groups
from barlake.llm.quality import base_rules, drop_low_quality, passes, prose_rules, quality_report
from barlake.llm.substring_dedup import remove_repeated_passages, sliding_min
from barlake.llm.text import LOWER, Words, range_hashes, sequence_hashes

ROWS = brute.documents()


def same(got, wanted):
    key = lambda row: repr(row)
    assert sorted(map(tuple, got), key=key) == sorted(wanted, key=key)


@pytest.fixture(scope="module")
def docs(spark):
    return brute.frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return brute.frame(spark, [])


def test_words_are_those_between_blanks():
    texts = [(t or "").encode() for _, t in ROWS]
    found = Words(texts, LOWER)
    for i, text in enumerate(texts):
        assert found.joined(found.bounds[i], found.bounds[i + 1]).split() == text.lower().split()


def test_hashes_tell_sequences_apart():
    hashes = Words([b"a b c a b c b a"], LOWER).hashes
    assert hashes[0] == hashes[3] and len(set(hashes.tolist())) == 3
    two = sequence_hashes(hashes, 2).tolist()
    assert two[0] == two[3] and len(set(two)) == 5
    ranges = range_hashes(hashes, np.array([0, 3, 0]), np.array([3, 6, 2])).tolist()
    assert ranges[0] == ranges[1] != ranges[2]


@pytest.mark.parametrize("width", [1, 2, 7, 43])
def test_sliding_min(width):
    values = np.random.default_rng(0).integers(0, 99, 100).astype(np.uint64)
    wanted = [values[i : i + width].min() for i in range(len(values) - width + 1)]
    assert sliding_min(values, width).tolist() == wanted
    assert len(sliding_min(values[:3], 4)) == 0


@pytest.mark.parametrize("batches, fan_in", [(1, 3), (4, 2)])
def test_line_dedup(docs, batches, fan_in):
    got = line_dedup_report(docs, batches=batches, fan_in=fan_in).collect()
    same(got, brute.line_dedup(ROWS))


def test_line_dedup_keeps_rows_and_columns(docs, none):
    kept = drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    wanted = [(d, None if t is None else k) for (d, t), (_, _, _, k) in zip(ROWS, brute.line_dedup(ROWS))]
    same(kept.select("doc_id", "text").collect(), wanted)
    assert line_dedup_report(none).count() == 0


ITEMS = [
    (1, " ".join(brute.words(ROWS[0][1])[:30])),
    (2, " ".join(brute.words(ROWS[1][1])[3:40]).upper() + "!!"),
    (2, "two words"),
    (None, " ".join(brute.words(ROWS[2][1])[:20])),
    (4, None),
    (5, " ,;"),
    (6, "one"),
    (7, " ".join(brute.words(ROWS[0][1])[:30])),
]


@pytest.mark.parametrize("block_rows", [10_000, 7])
def test_decontamination(spark, docs, block_rows):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = find_contamination(docs, items, block_rows=block_rows)
    got = found.select("doc_id", "n_words", hit_words(), "items").collect()
    wanted = brute.contamination(ROWS, ITEMS)
    assert any(hit for _, _, hit, _ in wanted)
    same(got, wanted)


def test_decontamination_filters_and_takes_empty_tables(spark, docs, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    clean = [r for r, (_, n, hit, _) in zip(ROWS, brute.contamination(ROWS, ITEMS)) if not (hit and 20 * hit >= n)]
    same(kept.select("doc_id", "text").collect(), clean)
    assert find_contamination(none, items).count() == 0
    found = find_contamination(docs, items.limit(0))
    assert found.filter(contaminated() | (F.size("items") > 0)).count() == 0 and found.count() == len(ROWS)


def test_quality(docs, none):
    report = quality_report(docs)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    wanted = []
    for doc, text in ROWS:
        counts = brute.quality(text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        wanted.append((doc, *counts, failed, brute.passes_quality(text)))
    same(report.collect(), wanted)
    assert quality_report(none).count() == 0


def test_quality_filter_does_not_depend_on_the_order_of_rules(docs):
    kept = drop_low_quality(docs)
    assert kept.columns == docs.columns
    same(kept.select("doc_id", "text").collect(), [r for r in ROWS if brute.passes_quality(r[1])])
    from barlake.llm.quality import _prepared

    rules = [*base_rules(), *prose_rules()]
    verdicts = _prepared(docs).select(passes(rules).alias("a"), passes(rules[::-1]).alias("b"))
    assert verdicts.filter("a <> b OR a IS NULL").count() == 0


def test_min_max_values_agree_as_often_as_sets():
    rng = np.random.default_rng(3)
    shared, own = rng.integers(0, 2**63, (2, 3000), dtype=np.uint64)
    agree = [
        np.mean(min_max(np.append(shared[k : k + 200], own[k : k + 50])) == min_max(np.append(shared[k : k + 200], own[k + 1000 : k + 1050])))
        for k in range(0, 2000, 100)
    ]
    assert abs(np.mean(agree) - 200 / 300) < 0.03


def test_bands_miss_fewer_than_one_pair_in_a_million():
    for percent in (80, 85, 95):
        rows = band_rows(percent)
        assert (1 - (percent / 100) ** rows) ** (140 // rows) < 1e-6


@pytest.mark.parametrize("size, percent, chunk", [(3, 85, 1024), (3, 85, 2), (5, 80, 1024)])
def test_near_duplicates(docs, size, percent, chunk):
    got = near_duplicate_groups(docs, size, percent, chunk_docs=chunk).collect()
    groups = brute.near_groups(ROWS, size, percent)
    assert sum(d != g for d, g in groups.items()) >= 4
    same(got, [(d, len(brute.shingles(t, size)), groups.get(d)) for d, t in ROWS])


def test_near_duplicates_leave_one_of_each_group(docs, none):
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = brute.near_groups(ROWS)
    same(kept.select("doc_id", "text").collect(), [r for r in ROWS if groups.get(r[0]) == r[0]])
    assert near_duplicate_groups(none).count() == 0


def test_near_duplicates_in_one_large_group(spark):
    """A chain of edits: neighbours are linked, the ends are far apart."""
    rng = random.Random(5)
    text, rows = [f"w{i}" for i in range(300)], []
    for i in range(60):
        rows.append((100 - i, " ".join(text)))
        for k in rng.sample(range(300), 4):
            text[k] = f"x{i}_{k}"
    got = dict(near_duplicate_groups(brute.frame(spark, rows, False), chunk_docs=8).select("doc_id", "component_id").collect())
    assert got == brute.near_groups(rows)


@pytest.mark.parametrize("bucket_strings", [4096, 1])
def test_repeated_passages(docs, bucket_strings):
    wanted = brute.passages(ROWS)
    assert sum(n > 0 for _, _, n, _ in wanted) >= 4
    same(remove_repeated_passages(docs, bucket_strings=bucket_strings).collect(), wanted)


def test_passages_of_one_word_and_no_rows(spark, none):
    rows = [(1, "x " * 9000), (2, "x " * 60), (3, "y " + "x " * 49), (4, "x\t" * 8000 + "z")]
    same(remove_repeated_passages(brute.frame(spark, rows)).collect(), brute.passages(rows))
    assert remove_repeated_passages(none).count() == 0


@pytest.mark.parametrize("chunk_tokens, part_keys", [(4_000_000, 2_000_000), (400, 500)])
def test_katz(docs, chunk_tokens, part_keys):
    wanted, sums, tokens = brute.katz(ROWS, good_turing)
    assert all(abs(s - 1) < 1e-9 for s in sums)
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "train_tokens"]
    got = katz_scores(docs, chunk_tokens, part_keys).select(columns).collect()
    key = lambda r: (repr(r[0]), r[2], r[4])
    for a, b in zip(sorted(got, key=key), sorted(wanted, key=key), strict=True):
        assert tuple(a[:4]) == b[:4] and a[6] == tokens
        assert a[4] == pytest.approx(b[4], abs=1e-6) and a[5] == pytest.approx(b[5], abs=1e-6)


def test_katz_without_training_rows(spark, none):
    held = [d for d in range(60) if brute.zlib.crc32(str(d).encode()) % 7 == 2]
    rows = [(d, "a b") for d in held]
    got = katz_scores(brute.frame(spark, rows)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got} == {(0, 0, 0.0, 0.0)}
    assert katz_scores(none).count() == 0


def test_good_turing_factors_are_discounts():
    rng = np.random.default_rng(0)
    for _ in range(50):
        factors = good_turing(rng.integers(0, 30, 6).tolist())
        assert ((0 < factors) & (factors <= 1)).all()
    assert Counter(good_turing([100, 40, 20, 12, 8, 5]) < 1)[True] == 5


def test_pairs_of_near_documents_share_a_band():
    from barlake.llm.near_dup import band_keys

    rng = np.random.default_rng(8)
    for _ in range(200):
        base = rng.integers(0, 2**63, 400, dtype=np.uint64)
        sets = [np.append(base, rng.integers(0, 2**63, 30, dtype=np.uint64)) for _ in range(2)]
        keys = band_keys(np.stack([min_max(s) for s in sets]), band_rows(85))
        assert (keys[0] == keys[1]).any()


def test_a_hot_minimiser_is_split(spark, monkeypatch):
    """Nine tenths of the runs on one minimiser: the join that keeps shared runs gives them to several tasks."""
    from barlake.llm import substring_dedup

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    store, plans = substring_dedup.stored, {}

    def watched(rows, name, *parts):
        if name == "shared-runs":
            rows.collect()
            plans[name] = rows._jdf.queryExecution().executedPlan().toString()
        return store(rows, name, *parts)

    monkeypatch.setattr(substring_dedup, "stored", watched)
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(i, passage + f" tail{i}") for i in range(6000)]
    rows += [(6000 + i, " ".join(f"x{i % 300}y{k}" for k in range(60))) for i in range(600)]
    try:
        got = remove_repeated_passages(spark.createDataFrame(rows, brute.SCHEMA).repartition(8))
        assert got.filter("n_removed = 60").count() == 5999 + 300
    finally:
        for name in small:
            spark.conf.unset(name)
    assert "SortMergeJoin(skew=true)" in plans["shared-runs"]
