"""Plain Python versions of the operators, for small tables, and rows that are hard to handle."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)
BLANK = r"[\x20\x09-\x0D]"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(rng, n, vocabulary=400):
    made = [f"{'abcdefghij'[k % 10]}{'éouaeiöü'[k % 8]}w{k}" for k in rng.zipf(1.3, n) % vocabulary]
    return "".join(w + ("\n" if i % 9 == 8 else " ") for i, w in enumerate(made))


def documents(seed=1, count=40):
    """(doc_id, text): prose, copies, near copies, shared passages, and every odd case."""
    rng = np.random.default_rng(seed)
    texts = [prose(rng, int(n)) for n in rng.integers(5, 260, count)]
    passage = prose(rng, 70)
    texts += [texts[3], texts[3], texts[5].upper(), texts[7] + passage, passage + texts[9], texts[11] + "extra words"]
    near = prose(rng, 200)
    texts += [near, near + "tail one", "start " + near]
    texts += [None, "", " \t\n ", "one", "two words", "a\nb\na\n\n", "x " * 130, "İΑΣ ß é <|endoftext|> don't"]
    texts += [prose(rng, 30_000, 5_000), "nospace" * 20_000, "\x00 odd \x1f bytes\x7f"]
    order = rng.permutation(len(texts)).tolist()
    rows = [(10 * i + 2, texts[k]) for i, k in enumerate(order)]
    rows += [rows[4], rows[8], (None, texts[3]), (None, None)]
    return rows


SCHEMA = "doc_id long, text string"
#: Columns of operators' inputs, outputs and inner steps.
CLASHING = ["row", "size", "slot", "item", "key", "n_words", "spans", "items", "kept", "node", "root", "_dropped", "tid"]


def frame(spark, rows, extra=True):
    docs = spark.createDataFrame(rows, SCHEMA)
    if not extra:
        return docs
    from pyspark.sql import functions as F

    return docs.select("*", *(F.lit(None).cast("string").alias(c) for c in CLASHING))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_dedup(rows, least=10):
    key = lambda line: re.sub(rf"^{BLANK}+|{BLANK}+\Z", "", line).translate(ASCII_LOWER)
    holder = {}
    for doc, text in rows:
        if doc is not None and text is not None:
            for line in text.split("\n"):
                holder[key(line)] = min(doc, holder.get(key(line), doc))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = [doc is not None and len(key(x)) >= least and holder.get(key(x), doc) < doc for x in lines]
        out.append((doc, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return out


def letters(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def contamination(rows, items, size=13):
    windows = defaultdict(set)
    for item, text in items:
        w = letters(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add(item)
    out = []
    for doc, text in rows:
        w = letters(text)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (own := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[own] - {None}
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    w = words(text)
    count = Counter(zip(w, w[1:], w[2:]))
    repeated = {k for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def passes_quality(text):
    import regex

    n, chars, symbols, dup_lines, repeats = quality(text)
    text = text or ""
    rejected = (
        n < 50
        or 100 * repeats > 50 * n
        or 2 * symbols > n
        or chars < 2 * n
        or chars > 15 * n
        or 10 * len(regex.findall(r"\p{L}", text)) < 6 * chars
        or 10 * dup_lines > 5 * len(text.split("\n"))
    )
    return not rejected


def shingles(text, size):
    w = words((text or "").translate(ASCII_LOWER))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(zip(*(w[i:] for i in range(size))))


def near_groups(rows, size=3, percent=85):
    """{doc_id: smallest doc_id reachable}"""
    named = [(d, shingles(t, size)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in named}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(named):
        for b, t in named[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in parent}


def passages(rows, size=50):
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1 if doc is not None else 0):
            own = tuple(w[i : i + size])
            first[own] = min(doc, first.get(own, doc))
    out = []
    for doc, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - size + 1 if doc is not None else 0):
            if first[tuple(w[i : i + size])] < doc:
                gone.update(range(i, i + size))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def katz(rows, factors):
    """(doc_id, held_out, n_tokens, n_known, base_score, score) and the sums of some distributions."""
    docs = [
        (d, words((t or "").translate(ASCII_LOWER)) + ["\n"], zlib.crc32(str("" if d is None else d).encode()) % 7 == 2)
        for d, t in rows
    ]
    one, two, before = Counter(), Counter(), Counter()
    for _, w, held in docs:
        if not held:
            pairs = list(zip(["\t", *w], w))
            one.update(w)
            two.update(pairs)
            before.update(h for h, _ in pairs)
    n, v = sum(one.values()), len(one)
    n_of = lambda counts: [sum(c == r for c in counts.values()) for r in range(1, 7)]
    f1, f2 = factors(n_of(one)), factors(n_of(two))
    left = sum(c * (1 - f1[c]) for c in one.values() if c <= 5)
    scale = n if left else n + 1
    unknown = (left or 1) / scale
    word = lambda w: f1[min(one[w], 6)] * one[w] / scale if one[w] else unknown
    after = defaultdict(list)
    for (h, w), c in two.items():
        after[h].append((w, c))
    known = {}
    for h, followers in after.items():
        mass = sum(c * (1 - f2[c]) for _, c in followers if c <= 5)
        total = before[h] if mass else before[h] + 1
        known[h] = total, (mass or 1) / total / (1 - sum(word(w) for w, _ in followers))

    def probability(h, w):
        if h not in known:
            return word(w)
        total, weight = known[h]
        return f2[min(two[h, w], 6)] * two[h, w] / total if two[h, w] else weight * word(w)

    sums = [sum(probability(h, w) for w in [*one, "\r"]) for h in [*list(known)[:40], "\r"]]
    out = []
    for d, w, held in docs:
        base = sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w)
        score = sum(math.log10(probability(h, x)) for h, x in zip(["\t", *w], w))
        out.append((d, held, len(w), sum(one[x] > 0 for x in w), base, score))
    return out, sums, n


def exact_duplicates(rows):
    """(doc_id, keep_id, group_size, sha256) of each row, and the number of rows that stay."""
    normal = lambda t: re.sub(rf"{BLANK}+", " ", t or "")
    groups = defaultdict(list)
    for doc, text in rows:
        groups[normal(text)].append(doc)
    least = {t: min((d for d in docs if d is not None), default=None) for t, docs in groups.items()}
    return [(d, least[normal(t)], len(groups[normal(t)]), sha(normal(t))) for d, t in rows], len(groups)


def hard_negatives(rows, every=50, positives=5, negatives=3):
    """Rows are (vec_id, label, vector)."""
    fine = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    kept = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows if label is not None and fine(v)]
    clamp = lambda x: max(-(2**62), min(2**62, x))
    out = []
    for at, (anchor, label, vector) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        others = [(clamp(sum(x * y for x, y in zip(vector, v))), i, l) for n, (i, l, v) in enumerate(kept) if n != at]
        others.sort(key=lambda r: (-r[0], r[1] is None, r[1]))
        for score, positive, _ in [r for r in others if r[2] == label][:positives]:
            hard = [r for r in others if r[2] != label and 50 * score <= 100 * r[0] <= 95 * score][:negatives]
            out += [(anchor, positive, rank, r[1], score, r[0]) for rank, r in enumerate(hard, 1)]
    return out


def byte_of_letters():
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


def alignment(rows, merges, model):
    """Rows of the alignment by a tokenizer with merges of bytes and a piece model, and the counts of id pairs."""
    letters = byte_of_letters()
    parts, counts = [], Counter()
    for doc, text in rows:
        a = merges.encode(" " + (text or ""), add_special_tokens=False).ids
        b = model.encode(text or "")
        in_a = [bytes(letters[ch] for ch in merges.id_to_token(i)) for i in a]
        in_b = [
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        if not text or not b"".join(in_a) == b"".join(in_b) == (" " + text).encode():
            parts.append((doc, None))
            continue
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (in_a, in_b)]
        groups = {end: ([], []) for end in sorted(set(ends[0]) & set(ends[1]))}
        cuts, at = list(groups), np.array(list(groups))
        for side, ids in enumerate((a, b)):
            for place, token in zip(np.searchsorted(at, ends[side]).tolist(), ids):
                groups[cuts[place]][side].append(token)
        links = Counter((x, y) for own, other in groups.values() for x in own for y in other)
        counts.update(links.keys())
        parts.append((doc, (len(a), len(b), list(groups.values()), links)))
    top = {}
    for (x, _), n in counts.items():
        top[x] = max(n, top.get(x, 0))
    out = []
    for doc, part in parts:
        if part is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = part
        best = sum(n for (x, y), n in links.items() if counts[x, y] == top[x])
        text = ";".join(",".join(map(str, own)) + "|" + ",".join(map(str, other)) for own, other in groups)
        out.append(
            (doc, n_a, n_b, len(groups), sum(links.values()), best, sum(n * counts[p] for p, n in links.items()), sha(text))
        )
    return out, counts
