import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import llm_brute as brute
from barlake.llm.packing import (
    TokenIds,
    best_fit_decreasing,
    bin_completion,
    default_tokenizer,
    lower_bound,
    pack_documents,
)
from barlake.llm.sharding import lpt, shard_documents
from barlake.llm.token_counts import SPACE, PieceTrie, token_counts, zipf_pieces
from barlake.llm.url_filter import (
    DOUBLE_SUFFIXES,
    RULES,
    domain_of,
    judge_pages,
    links_by_number,
    strength,
    suffix_of,
    without_port,
)

ROWS = brute.documents(2)


@pytest.fixture(scope="module")
def docs(spark):
    return brute.frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


# Sharding


def test_lpt_gives_the_largest_to_the_least_loaded():
    assert lpt([(0, 5), (1, 9), (2, 5), (3, 3), (4, 3)], 2) == {1: 0, 0: 1, 2: 1, 3: 0, 4: 1}


@pytest.mark.parametrize("bundles, slices", [(32768, 8192), (3, 2)])
def test_sharding(docs, bundles, slices):
    got = shard_documents(docs, 4, bundles, slices).collect()
    text_of = lambda t: (t or "").encode()
    wanted = Counter((d, len(text_of(t)) + 16, zlib.crc32(text_of(t))) for d, t in ROWS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == wanted
    shards, load, slots = defaultdict(set), Counter(), defaultdict(list)
    for r in got:
        shards[r["text_crc32"]].add(r["shard"])
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in shards.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if bundles > 3:
        sizes = Counter()
        for d, t in ROWS:
            sizes[text_of(t)] += len(text_of(t)) + 16
        heap = [0] * 4
        for size in sorted(sizes.values(), reverse=True):
            heap[heap.index(min(heap))] += size
        assert sorted(load.values()) == sorted(x for x in heap if x)


def test_sharding_of_no_rows(spark):
    assert shard_documents(brute.frame(spark, [])).count() == 0


# Packing


def test_token_ids_are_the_tokenizers(tokenizer):
    odd = ["", "  ", "Don't we'll O'Neil's ΑΣ ΣΑΣ İ", "a<|endoftext|>b <|startoftext|>x", "é ́a 12 3a4", "ﬁ ẞ ǅ"]
    texts = [t or "" for _, t in ROWS[:30]] + odd + ["日本語 text 🙂!", "Ünï,,!! #a$ --- a_b a b", "\x00 a\x01b"]
    for limit in (1_000_000, 40):
        ids = TokenIds(default_tokenizer(), limit)
        for text in texts:
            assert ids([text.encode()])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def optimum(sizes, capacity):
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for room in {b for b in bins if b >= sizes[i]}:
            rest = list(bins)
            rest[rest.index(room)] -= sizes[i]
            place(i + 1, rest)
        place(i + 1, [*bins, capacity - sizes[i]])

    place(0, [])
    return best


def test_bin_completion_finds_optimal_packings():
    rng, better = random.Random(4), 0
    for _ in range(150):
        sizes = sorted((rng.randint(8, 60) for _ in range(rng.randint(1, 11))), reverse=True)
        counts = Counter(sizes)
        found = bin_completion(counts, 100)
        assert Counter(s for b in found for s in b) == counts and max(map(sum, found)) <= 100
        assert lower_bound(counts, 100) <= len(found) == optimum(sizes, 100)
        better += len(found) < len(best_fit_decreasing(counts, 100))
    assert better


def test_bin_completion_tries_fillings_of_many_pieces():
    counts = Counter([1000, 900, 300, 300, 290, 290, 290, 278, 224, 224])
    found = bin_completion(counts, 2048)
    assert len(found) == 2 and Counter(s for b in found for s in b) == counts


def test_bin_completion_fills_up_copies_with_many_pieces():
    rng = random.Random(5)
    counts = Counter([1000] * 200 + [rng.randint(150, 300) for _ in range(400)])
    found = bin_completion(counts, 2048)
    assert Counter(s for b in found for s in b) == counts and max(map(sum, found)) <= 2048
    assert lower_bound(counts, 2048) <= len(found) < len(best_fit_decreasing(counts, 2048))


def check_packing(rows, placed, tokenizer, capacity):
    pieces = defaultdict(list)
    for r in placed:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    wanted = defaultdict(list)
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            wanted[doc].append((k, start, len(own), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in own))))
    assert {d: sorted(p) for d, p in pieces.items()} == {d: sorted(p) for d, p in wanted.items()}
    sequences = defaultdict(list)
    for r in placed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize(("low", "high", "share"), [(600, 800, 0.93), (400, 700, 0.95), (300, 900, 0.985)])
def test_bin_completion_beats_best_fit_where_large_pieces_should_go_together(low, high, share):
    rng = random.Random(1)
    counts = Counter(rng.randint(low, high) for _ in range(16_384))
    found = bin_completion(counts, 2048)
    assert Counter(s for b in found for s in b) == counts and max(map(sum, found)) <= 2048
    assert len(found) <= share * len(best_fit_decreasing(counts, 2048))


def test_token_ids_of_odd_bytes_and_no_words(tokenizer):
    ids = TokenIds(default_tokenizer())
    assert [x.tolist() for x in ids([b"", b"  ", b"\n"])] == [[], [], []] and ids([]) == []
    odd = [b"\xff\xfe a", b" lead\x0btrail ", "ABC!! é;; 世界 x\x1cy z\xa0q a<|endoftext|>".encode()]
    for text, found in zip(odd, ids(odd)):
        want = [i for w in text.split() for i in tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids]
        assert found.tolist() == want


@pytest.mark.parametrize("group_pieces", [16_384, 9])
def test_packing(docs, tokenizer, group_pieces):
    placed = pack_documents(docs, capacity=256, group_pieces=group_pieces).collect()
    used = check_packing(ROWS, placed, tokenizer, 256)
    if group_pieces > len(placed):
        assert used <= lower_bound(Counter(r["length"] for r in placed), 256) + 1


def test_packing_with_ids_and_without_rows(spark, tokenizer):
    rows = [(1, "some words, more words"), (2, None)]
    placed = pack_documents(brute.frame(spark, rows), with_ids=True).collect()
    assert {r["doc_id"]: r["ids"] for r in placed} == {1: tokenizer.encode(rows[0][1]).ids + [0], 2: [0]}
    assert pack_documents(brute.frame(spark, [])).count() == 0


# Token counts


def segmentation(text, pieces, unknown):
    best = [(0.0, 0)]
    for stop in range(1, len(text) + 1):
        options = [(best[stop - 1][0] + unknown, -best[stop - 1][1] - 1)]
        options += [(pieces[text[a:stop]] + best[a][0], -best[a][1] - 1) for a in range(max(0, stop - 60), stop) if text[a:stop] in pieces]
        score, tokens = max(options)
        best.append((score, -tokens))
    return best[-1]


def test_token_counts(docs, spark):
    pieces, unknown = zipf_pieces()
    small = [r for r in ROWS if len(r[1] or "") < 2000]
    known = {}
    for r in token_counts(brute.frame(spark, small)).collect():
        known.setdefault(r["doc_id"], []).append((r["n_words"], r["n_tokens"], round(r["log_prob"], 6)))
    wanted = {}
    for doc, text in small:
        parts = [segmentation(SPACE + w.encode(), pieces, unknown) for w in brute.words(text)]
        counts = len(parts), sum(n for _, n in parts), round(math.fsum(s for s, _ in parts), 6)
        wanted.setdefault(doc, []).append(counts)
    assert {d: sorted(c) for d, c in known.items()} == {d: sorted(c) for d, c in wanted.items()}
    assert token_counts(docs).count() == len(ROWS) and token_counts(docs.limit(0)).count() == 0


def test_a_shared_prefix_is_scored_once():
    trie = PieceTrie({SPACE + b"ab": -1.0, b"c": -2.0, b"cd": -2.5}, -9.0, limit=100)
    trie.learn({b"abc", b"abcd", b"abd"})
    assert len(trie._score) == 1 + len(SPACE) + len("abc") + 1 + 1
    assert trie.counts == {b"abc": 2, b"abcd": 2, b"abd": 2} and trie.scores[b"abd"] == -10.0
    trie.learn({bytes([i, k]) for i in range(33, 60) for k in range(33, 60)})
    trie.learn({b"abc"})
    assert trie.counts[b"abc"] == 2


# URL filters


PAGES = [
    (1, "http://Sub.Example.ORG/es/1?x#y"),
    (2, "https://example.org/en/12"),
    (3, "https://notexample.org/en/12#a"),
    (4, "http://a.com/fr/x"),
    (5, "http://a.com/de/"),
    (6, "http://a.com/?q=/de/"),
    (7, "http://a.com"),
    (8, None),
    (9, "no scheme"),
    (9, "no scheme"),
    (None, "http://b.net/x"),
    (10, "http://org"),
    (11, "http://org/#"),
    (12, "://://"),
]
HOSTS = ["sub.example.org", "example.org", "notexample.org", "a.com", "a.com", "a.com", "a.com", "", "", "", "b.net", "org", "org", ":"]
PATHS = ["/es/1", "/en/12", "/en/12", "/fr/x", "/de/", "/", "", "", "", "", "/x", "", "/", "//"]
FOUND = ["example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", *[None] * 7, "org/", None]


def test_rules(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS n", "'y' AS rule")
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    got = judge_pages(pages, labels).select("page_id", "host", "path", "rule", "verdict").collect()
    verdicts = [dict(RULES).get(rule, "allow") for rule in FOUND]
    wanted = [(p, *rest) for (p, _), *rest in zip(PAGES, HOSTS, PATHS, FOUND, verdicts)]
    assert Counter(map(tuple, got)) == Counter(wanted)
    assert judge_pages(pages.limit(0), labels).count() == 0


def test_reputation_shrinks_towards_the_domain(spark):
    hosts = {"bad.one.net": (60, 58), "few.one.net": (1, 1), "none.one.net": (0, 0), "good.two.net": (80, 2), "new.two.net": (0, 0)}
    pages, labels, number = [], [], 0
    for host, (n, k) in hosts.items():
        for i in range(max(n, 1)):
            pages.append((number, f"http://{host}/{i}"))
            if i < n:
                labels += [(number, i < k)]
            number += 1
    labels += [labels[0], (None, True), (3, None)]
    pages = spark.createDataFrame(pages, "page_id long, url string")
    got = judge_pages(pages, spark.createDataFrame(labels, "page_id long, bad boolean")).collect()
    rate = {r["host"]: r["bad_rate"] for r in got}
    assert rate["none.one.net"] < min(rate["few.one.net"], rate["bad.one.net"])
    assert rate["new.two.net"] < rate["none.one.net"] and rate["good.two.net"] < 0.1
    assert {r["verdict"] for r in got if r["host"] == "bad.one.net"} == {"block"}
    assert {r["verdict"] for r in got if r["host"] in ("good.two.net", "new.two.net")} == {"allow"}
    assert strength(0, 0, 0, 0, 0) == 10 and 1 <= strength(100, 50, 40, 1000, 10) <= 999


def test_labels_reach_pages_by_their_document(spark):
    """Documents 100 to 139 are bad; pages 0 to 39 are made of them, and pages 100 to 139 of others."""
    pages = [(i, f"http://bad.one.net/en/{100 + i}.html?page=2") for i in range(40)]
    pages += [(100 + i, f"https://good.two.net/en/{900 + i}/#top") for i in range(40)] + [(7000, "http://bad.one.net/x"), (7001, None)]
    pages = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame([(100 + i, True) for i in range(40)] + [(900 + i, False) for i in range(40)] + [(100, False)], "doc_id long, bad boolean")
    links = links_by_number(pages)
    assert {tuple(r) for r in links.collect()} == {(i, 100 + i) for i in range(40)} | {(100 + i, 900 + i) for i in range(40)}
    got = judge_pages(pages, labels, links=links.unionByName(links)).select("host", "verdict").distinct().collect()
    assert {tuple(r) for r in got} == {("bad.one.net", "block"), ("good.two.net", "allow"), ("", "allow")}


def test_ports_and_double_suffixes(spark):
    hosts = ["a.b.co.uk:8080", "b.co.uk", "co.uk", "x.uk:1", "a.example.com", "com:80", ""]
    name = without_port(F.col("host"))
    rows = spark.createDataFrame([(h,) for h in hosts], "host string").select(
        domain_of(name, DOUBLE_SUFFIXES), suffix_of(name, DOUBLE_SUFFIXES)
    )
    assert [tuple(r) for r in rows.collect()] == [
        ("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("x.uk", "uk"), ("example.com", "com"), ("com", "com"), ("", "")
    ]


def test_a_host_is_judged_by_the_rate_of_its_suffix(spark):
    """A third of all pages is bad: only the host far above that is blocked, also where most of its pages are good."""
    bad = {"worse.one.net": 45, "usual.two.net": 30, "usual.six.net": 30, "better.ten.net": 15}
    pages = [(100 * h + i, f"http://{host}/{i}") for h, host in enumerate(bad) for i in range(100)]
    labels = [(100 * h + i, i < k) for h, k in enumerate(bad.values()) for i in range(100)]
    judged = judge_pages(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad boolean")
    ).select("host", "verdict").distinct()
    assert {tuple(r) for r in judged.collect()} == {(h, "block" if "worse" in h else "allow") for h in bad}


# Pipeline


def test_pipeline(spark, tmp_path, tokenizer):
    """Every stage against its plain version, on what the stage before it kept."""
    items = [(1, " ".join(brute.words(ROWS[0][1])[:40])), (2, None)]
    spark.createDataFrame(ROWS, brute.SCHEMA).selectExpr(
        "*", "'en' AS lang", "'s' AS source", "cast(char_length(text) AS bigint) AS n_chars"
    ).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [r for r in ROWS if brute.passes_quality(r[1])]
    rows = [(d, None if t is None else kept) for (d, t), (_, _, _, kept) in zip(rows, brute.line_dedup(rows))]
    groups = brute.near_groups(rows, 5, 80)
    rows = [r for r in rows if r[0] is None or groups[r[0]] == r[0]]
    rows = [r for r, (_, n, hit, _) in zip(rows, brute.contamination(rows, items)) if not (hit and 20 * hit >= n)]
    placed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    check_packing(rows, placed, tokenizer, 2048)
    assert 0 < len({d for d, _ in rows}) < len({d for d, _ in ROWS})
