"""Quality rules as a short-circuit cascade, in DataFrame functions only.

On a sample, each rule's cost and the share of documents that it rejects are measured. Rules are
then tried in the order of rejections per second, and a document's first rejection ends the
trial, so that costly rules meet only what cheap ones let pass. A verdict is the conjunction of
all rules: the order, and with it the sample, changes the work and never the result.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .storage import stored

_BLANKS = " \t\n\x0b\x0c\r"
_BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"

# --------------------------------------------------------------------------
# Counts of a text; ``_text`` is never null and ``_words`` are its words


def _prepared(docs: DataFrame) -> DataFrame:
    """``row`` with all columns of docs, ``_text`` and ``_words``.

    The words come out of a generator of one row, through which the optimizer moves no filter. It would
    put their expression in the place of their name, also inside lambdas, and split the text for each word.
    """
    rows = docs.select(F.struct("*").alias("row"), F.coalesce("text", F.lit("")).alias("_text"))
    bare = F.btrim("_text", F.lit(_BLANKS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{_BLANK}+", -1))
    return rows.select("*", F.explode(F.array(words)).alias("_words"))


def n_words() -> Column:
    return F.size("_words")


def word_chars() -> Column:
    return F.char_length(F.array_join("_words", ""))


def n_symbols() -> Column:
    return F.char_length(F.regexp_replace("_text", f"[^{SYMBOLS}]+", ""))


def n_dup_lines() -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split("_text", "\n", -1), lambda line: F.btrim(line, F.lit(_BLANKS)) != "")
    return F.size(lines) - F.size(F.array_distinct(lines))


def n_repeat_words() -> Column:
    """Words inside 3-word windows that occur twice or more.

    Each window carries its place behind its words, so that sorting brings equal windows
    together; no words hold blanks. The sorted places of repeated windows then cover three words
    each, or fewer up to the next one. Work grows as n log n in the words of a text.
    """
    starts = F.slice("_words", 1, F.greatest(F.size("_words") - 2, F.lit(0)))
    keyed = F.transform(
        starts,
        lambda word, i: F.concat_ws(" ", word, F.get("_words", i + 1), F.get("_words", i + 2), i.cast("string")),
    )
    windows = F.transform(
        F.sort_array(keyed),
        lambda key: F.struct(
            F.substring_index(key, " ", 3).alias("text"), F.substring_index(key, " ", -1).cast("int").alias("place")
        ),
    )
    return _bound(_bound(windows, _repeated_places), _covered)


def _repeated_places(windows: Column) -> Column:
    """Sorted places of windows that equal a neighbour."""
    same = F.transform(
        windows,
        lambda w, i: F.when(
            w["text"].eqNullSafe(F.get(windows, i - 1)["text"]) | w["text"].eqNullSafe(F.get(windows, i + 1)["text"]),
            w["place"],
        ),
    )
    return F.sort_array(F.array_compact(same))


def _covered(places: Column) -> Column:
    widths = F.transform(
        places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3)))
    )
    return F.aggregate(widths, F.lit(0), lambda total, n: total + n)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# --------------------------------------------------------------------------
# Rules and cascade


@dataclass(frozen=True)
class Rule:
    """``reject`` is a condition over ``_text`` and ``_words``, null counting as no rejection."""

    name: str
    reject: Column


def base_rules() -> list[Rule]:
    return [
        Rule("few_words", n_words() < 50),
        Rule("repeated_words", 100 * n_repeat_words() > 50 * n_words()),
    ]


def prose_rules() -> list[Rule]:
    """Signs of text that is not prose, in any language that parts words by blanks."""
    letters = F.char_length(F.regexp_replace("_text", r"[^\p{L}]+", ""))
    return [
        Rule("symbols", 2 * n_symbols() > n_words()),
        Rule("word_length", (word_chars() < 2 * n_words()) | (word_chars() > 15 * n_words())),
        Rule("few_letters", 10 * letters < 6 * word_chars()),
        Rule("repeated_lines", 10 * n_dup_lines() > 5 * F.size(F.split("_text", "\n", -1))),
    ]


def by_rejection_per_cost(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = 2000) -> list[Rule]:
    """Rules with the most rejections per second first, as measured on a sample of documents.

    ``sample_rows`` is the expected size of the sample; it decides only the order.
    """
    few = docs.select("text").sample(min(1.0, sample_rows / max(1, docs.count())), seed=7)
    sample = stored(_prepared(few).select("_text", "_words"), "quality-sample")
    rejected = sample.agg(*(F.count_if(r.reject).alias(r.name) for r in rules)).first()

    def seconds(condition: Column) -> float:
        start = time.perf_counter()
        sample.agg(F.count_if(condition)).collect()
        return time.perf_counter() - start

    idle = min(seconds(n_words() < 0) for _ in range(2))
    rate = {r.name: rejected[r.name] / max(1e-3, seconds(r.reject) - idle) for r in rules}
    return sorted(rules, key=lambda r: (-rate[r.name], r.name))


def passes(rules: Sequence[Rule]) -> Column:
    """True if no rule rejects; later rules are evaluated only for rows that earlier ones let pass."""
    verdict = F.when(rules[0].reject, False) if rules else F.lit(True)
    for rule in rules[1:]:
        verdict = verdict.when(rule.reject, False)
    return verdict.otherwise(True) if rules else verdict


def quality_report(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """Counts and verdict for every row of ``docs`` (doc_id, text).

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (fewer than 50
    words, or more than half of them in repeated 3-word windows) and kept: not base_failed and
    rejected by none of ``rules``, prose_rules() by default. A null text counts as empty. Every
    row is judged by itself: repeated rows get the same verdict, no rows give no rows.
    """
    rows = _prepared(docs.select("doc_id", "text"))
    ordered = by_rejection_per_cost(docs, prose_rules() if rules is None else rules, sample_rows)
    counts = {
        "n_words": n_words(),
        "word_chars": word_chars(),
        "n_symbols": n_symbols(),
        "n_dup_lines": n_dup_lines(),
        "n_repeat_words": n_repeat_words(),
    }
    counted = rows.select(
        F.col("row.doc_id").alias("doc_id"),
        *(value.cast("bigint").alias(name) for name, value in counts.items()),
        passes(ordered).alias("passed"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.select(
        "doc_id", *counts, failed.alias("base_failed"), (~failed & F.col("passed")).alias("kept")
    )


def drop_low_quality(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """Rows of ``docs`` that no rule rejects, with their columns; by default base and prose rules.

    A null text counts as empty, so the base rules reject it.
    """
    rows = _prepared(docs)
    ordered = by_rejection_per_cost(docs, [*base_rules(), *prose_rules()] if rules is None else rules, sample_rows)
    return rows.filter(passes(ordered)).select("row.*")
