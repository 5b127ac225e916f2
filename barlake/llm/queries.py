"""Registered queries of the operators in this package, and the SQL some must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .alignment import align_tokenizers
from .decontaminate import contaminated, find_contamination, hit_words
from .exact_dedup import exact_duplicates
from .hard_negatives import hard_negatives
from .katz import katz_scores
from .line_dedup import line_dedup_report
from .near_dup import near_duplicate_groups
from .packing import pack_documents
from .quality import quality_report
from .sharding import shard_documents
from .substring_dedup import remove_repeated_passages
from .token_counts import token_counts
from .url_filter import DOUBLE_SUFFIXES, RULES, judge_pages, links_by_number

SHARDS = 40


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op1_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_contamination(_documents(spark, sf_dir), _benchmark(spark, sf_dir))
    names = F.array_join(F.sort_array(F.transform("items", lambda i: i.cast("string"))), ",")
    return rows.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def op2_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(_documents(spark, sf_dir))


def op3_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_documents(spark, sf_dir))


def op4_lpt_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_documents(_documents(spark, sf_dir), SHARDS)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir))


def op6_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels judge documents; a page is made of the document whose number stands in its url."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    judged = judge_pages(pages, labels.select("doc_id", bad.alias("bad")), links=links_by_number(pages))
    rounded = [F.round(c, 6).alias(c) for c in ("bad_rate", "lower_bound")]
    return judged.select("page_id", "host", "path", "rule", "verdict", *rounded)


def op7_super_kmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeated_passages(_documents(spark, sf_dir))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_min_max_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_duplicate_groups(_documents(spark, sf_dir))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup_report(_documents(spark, sf_dir))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(_documents(spark, sf_dir))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(_documents(spark, sf_dir))[0]


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select("vec_id", label.alias("label"), F.col("embedding").alias("vector"))
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op13_golomb_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_wu_manber_decontamination": op1_wu_manber_decontamination,
        "op2_katz_scores": op2_katz_scores,
        "op3_trie_token_counts": op3_trie_token_counts,
        "op4_lpt_sharding": op4_lpt_sharding,
        "op5_bin_completion": op5_bin_completion,
        "op6_host_reputation": op6_host_reputation,
        "op7_super_kmer_dedup": op7_super_kmer_dedup,
        "op8_min_max_near_dedup": op8_min_max_near_dedup,
        "op9_line_dedup": op9_line_dedup,
        "op10_quality_cascade": op10_quality_cascade,
        "op11_tokenizer_alignment": op11_tokenizer_alignment,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_golomb_exact_dedup": op13_golomb_exact_dedup,
    }


_BLANKS = r"[\x20\x09-\x0D]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_LINE_DEDUP = f"""
    WITH l AS (
        SELECT doc_id, pos, lines[pos] AS line,
               translate(regexp_replace(lines[pos], '^{_BLANKS}+|{_BLANKS}+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS key
        FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS pos
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
    ), h AS (SELECT key, min(doc_id) AS holder FROM l WHERE length(key) >= 10 GROUP BY key),
    m AS (SELECT l.*, coalesce(h.holder < l.doc_id, false) AS gone FROM l LEFT JOIN h ON l.key = h.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id
"""


# Windows of 13 words, or of a whole shorter item, joined on their text.
_DECONTAMINATION = f"""
    WITH words AS (
        SELECT 'd' AS kind, doc_id AS id, w FROM (SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents)
        UNION ALL SELECT 'b', item_id, w FROM (SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark)
    ), items AS (
        SELECT DISTINCT id AS item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
        FROM (SELECT id, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM words WHERE kind = 'b' AND len(w) > 0)
    ), sizes AS (SELECT DISTINCT size FROM items),
    places AS (
        SELECT id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
        FROM (SELECT id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
              FROM words, sizes WHERE kind = 'd' AND len(w) >= size)
    ), hits AS (SELECT p.id, p.i, p.size, item_id FROM places p JOIN items USING (size, win)),
    marked AS (SELECT id, count(DISTINCT k) AS n FROM (
        SELECT DISTINCT id, unnest(generate_series(i, i + size - 1)) AS k FROM hits) GROUP BY id),
    named AS (SELECT id, count(*) AS n, string_agg(cast(item_id AS varchar), ',' ORDER BY cast(item_id AS varchar)) AS names
              FROM (SELECT DISTINCT id, item_id FROM hits) GROUP BY id)
    SELECT w.id AS doc_id, cast(len(w) AS bigint) AS n_words, coalesce(m.n, 0) AS n_hit, coalesce(x.n, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256,
           coalesce(m.n, 0) > 0 AND 20 * coalesce(m.n, 0) >= len(w) AS contaminated
    FROM words w LEFT JOIN marked m ON m.id = w.id LEFT JOIN named x ON x.id = w.id WHERE kind = 'd'
"""


def _prior_size(level: str) -> str:
    return f"""(SELECT CASE WHEN count(*) < 2 OR coalesce(sum(n), 0) = 0 THEN 10.0
        WHEN (sum(k) / sum(n)) * (1 - sum(k) / sum(n)) * (sum(n) - sum(n * n) / sum(n) - (count(*) - 1)) <= 0 THEN 10.0
        ELSE 1 / least(greatest((sum(k * k / n) - sum(k) * sum(k) / sum(n) - (sum(k) / sum(n)) * (1 - sum(k) / sum(n)) * (count(*) - 1))
             / ((sum(k) / sum(n)) * (1 - sum(k) / sum(n)) * (sum(n) - sum(n * n) / sum(n) - (count(*) - 1))), 0.001), 0.5) - 1 END
        FROM {level} WHERE n > 0)"""


def _shrunk(prior: str, level: str, table: str) -> str:
    return f"(({prior}) * {_prior_size(level)} + {table}.k) / ({_prior_size(level)} + {table}.n)"


_RULES_FIT = ", ".join(f"('{rule}', '{verdict}', '{rule.split('/', 1)[0]}', '/{rule.split('/', 1)[1]}')" for rule, verdict in RULES)

_DOUBLE = ", ".join(f"'{suffix}'" for suffix in DOUBLE_SUFFIXES)

_REPUTATION = f"""
    WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
    i AS (SELECT DISTINCT page_id, try_cast(nullif(regexp_extract(path, '^.*/([0-9]+)(?:[./]|$)', 1), '') AS bigint) AS doc_id FROM u),
    b AS (SELECT page_id, max(quality = 0 OR toxic = 1) AS bad FROM i JOIN labels USING (doc_id) GROUP BY page_id),
    c AS (SELECT host, cast(count(bad) AS double) AS n, cast(coalesce(sum(bad::int), 0) AS double) AS k,
                 list_reverse(string_split(regexp_replace(host, ':[0-9]*$', ''), '.')) AS labels,
                 array_to_string(list_reverse(labels[1:2]), '.') IN ({_DOUBLE}) AS doubled FROM u LEFT JOIN b USING (page_id) GROUP BY host),
    h AS (SELECT host, n, k, array_to_string(list_reverse(labels[1:CASE WHEN doubled THEN 3 ELSE 2 END]), '.') AS domain,
                 array_to_string(list_reverse(labels[1:CASE WHEN doubled THEN 2 ELSE 1 END]), '.') AS suffix FROM c),
    d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY domain, suffix),
    s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY suffix),
    sr AS (SELECT suffix, {_shrunk("(SELECT (sum(k) + 1) / (sum(n) + 2) FROM s)", "s", "s")} AS rate FROM s),
    dr AS (SELECT domain, sr.rate AS suffix_rate, {_shrunk("sr.rate", "d", "d")} AS rate FROM d JOIN sr USING (suffix)),
    hr AS (SELECT host, n, suffix_rate, {_shrunk("dr.rate", "h", "h")} AS rate FROM h JOIN dr USING (domain)),
    lb AS (SELECT *, rate - sqrt(rate * (1 - rate) / ({_prior_size("h")} + n + 1)) AS bound FROM hr),
    v AS (SELECT host, rate, bound, CASE WHEN bound > suffix_rate THEN 'block' ELSE 'allow' END AS learned FROM lb),
    f AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
          FROM (SELECT DISTINCT host, path FROM u), (VALUES {_RULES_FIT}) t(rule, verdict, under, opening)
          WHERE (host = under OR ends_with(host, '.' || under)) AND starts_with(path, opening) GROUP BY host, path)
    SELECT page_id, u.host, u.path, f.rule, coalesce(f.verdict, v.learned) AS verdict,
           round(rate, 6) AS bad_rate, round(bound, 6) AS lower_bound
    FROM u JOIN v ON v.host = u.host LEFT JOIN f ON f.host = u.host AND f.path = u.path
"""

_WORDS = f"regexp_extract_all({{text}}, '[^\\x20\\x09-\\x0D]+')"
_LOWERED = _WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")
_UNCHANGED = _WORDS.format(text="coalesce(text, '')")

_NEAR_DUPLICATES = f"""
    WITH RECURSIVE w AS (SELECT doc_id, {_LOWERED} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle
          FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM w WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b USING (shingle)
          WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
    l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 85 * (a.n + b.n - i)),
    r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
    c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
    SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM c LEFT JOIN n USING (doc_id)
"""


_PASSAGES = f"""
    WITH w AS (SELECT doc_id, {_UNCHANGED} AS w FROM documents),
    p AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS win
          FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM w)),
    f AS (SELECT win, min(doc_id) AS holder FROM p GROUP BY win HAVING count(*) > 1),
    g AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS k
          FROM p JOIN f USING (win) WHERE holder < doc_id),
    t AS (SELECT doc_id, k, w[k] AS word FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS k FROM w)),
    m AS (SELECT t.*, g.k IS NOT NULL AS gone FROM t LEFT JOIN g ON g.doc_id = t.doc_id AND g.k = t.k),
    a AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed,
                 string_agg(word, ' ' ORDER BY k) FILTER (NOT gone) AS kept FROM m GROUP BY doc_id)
    SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_removed, 0) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM w LEFT JOIN a USING (doc_id)
"""


_QUALITY = f"""
    WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {_UNCHANGED} AS w, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
    p AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS win
          FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w)),
    d AS (SELECT doc_id, win FROM p GROUP BY doc_id, win HAVING count(*) > 1),
    r AS (SELECT doc_id, count(DISTINCT k) AS n FROM
          (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM p JOIN d USING (doc_id, win)) GROUP BY doc_id),
    c AS (SELECT w.doc_id, cast(len(w) AS bigint) AS n_words, length(array_to_string(w, '')) AS word_chars,
                 length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                 cast(len(list_filter(l, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]'))) - len(list_distinct(
                     list_filter(l, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS bigint) AS n_dup_lines,
                 coalesce(r.n, 0) AS n_repeat_words, len(l) AS n_lines,
                 length(regexp_replace(t, '[^\\p{{L}}]', '', 'g')) AS n_letters
          FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 2 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
                OR 10 * n_letters < 6 * word_chars OR 10 * n_dup_lines > 5 * n_lines) AS kept FROM b
"""


_HARD_NEGATIVES = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * cast(x AS DOUBLE))) AS w
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label,
                 cast(list_inner_product(a.w, c.w) AS BIGINT) AS score
          FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, positive_id,
           cast(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> anchor_label
         AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3
"""

_EXACT_DUPLICATES = f"""
    WITH n AS (SELECT doc_id, sha256(t) AS text_sha256, t
               FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_BLANKS}+', ' ', 'g') AS t FROM documents)),
    g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (t)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_wu_manber_decontamination": _DECONTAMINATION,
        "op6_host_reputation": _REPUTATION,
        "op7_super_kmer_dedup": _PASSAGES,
        "op8_min_max_near_dedup": _NEAR_DUPLICATES,
        "op9_line_dedup": _LINE_DEDUP,
        "op10_quality_cascade": _QUALITY,
        "op12_hard_negatives": _HARD_NEGATIVES,
        "op13_golomb_exact_dedup": _EXACT_DUPLICATES,
    }
