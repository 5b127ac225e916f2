"""URL filters: rules first, then host reputation by empirical Bayes.

Labelled pages give each host a number of bad outcomes. Rates shrink through three beta-binomial levels:
a suffix towards the rate of all pages, a registered domain towards its suffix, a host towards its
domain. How strongly is estimated from the spread between the members of each level. A host is
blocked if even the lower bound of its posterior bad rate is above the rate of its suffix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .storage import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The rules of the contract as (rule, verdict).
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
MAX_RULES = 1000

#: Suffixes of two labels under which names are registered, of the larger countries that have such; pass a fuller list where it matters.
DOUBLE_SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.za", "co.in",
    "co.jp", "ne.jp", "or.jp", "co.kr", "com.br", "com.mx", "com.tr", "com.cn", "com.tw", "com.hk",
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def links_by_number(pages: DataFrame) -> DataFrame:
    """(page_id, doc_id) by the last number that is a part of the url's path; pages without one give no row."""
    number = F.regexp_extract(path_of(F.col("url")), r"^.*/([0-9]+)(?:[./]|$)", 1)
    links = pages.select("page_id", F.nullif(number, F.lit("")).try_cast("bigint").alias("doc_id"))
    return links.filter("doc_id IS NOT NULL").distinct()


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does. The longer host decides between equals."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    order = sorted(rules, key=lambda r: (-len(r[0]), -r[0].index("/"), r[0]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, decision in reversed(order):
        at, start = rule.split("/", 1)
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + start)
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def without_port(host: Column) -> Column:
    return F.regexp_replace(host, ":[0-9]*$", "")


def suffix_of(host: Column, double_suffixes: Sequence[str] = ()) -> Column:
    two = F.substring_index(host, ".", -2)
    one = F.substring_index(host, ".", -1)
    return F.when(two.isin(*double_suffixes), two).otherwise(one) if double_suffixes else one


def domain_of(host: Column, double_suffixes: Sequence[str] = ()) -> Column:
    two = F.substring_index(host, ".", -2)
    if not double_suffixes:
        return two
    return F.when(two.isin(*double_suffixes), F.substring_index(host, ".", -3)).otherwise(two)


def _moments() -> list[Column]:
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    return [F.sum(n), F.sum(k), F.sum(k * k / n), F.sum(n * n), F.count(F.lit(1))]


def strength(n: float, k: float, square: float, weight: float, groups: int) -> float:
    """Size of the beta prior by moments: the correlation inside groups, kept between 0.001 and 0.5."""
    if not n or groups < 2:
        return 10.0
    rate = k / n
    spread, free = rate * (1 - rate), n - weight / n - (groups - 1)
    if spread * free <= 0:
        return 10.0
    inside = (square - k * k / n - spread * (groups - 1)) / (spread * free)
    return 1 / min(max(inside, 0.001), 0.5) - 1


def host_reputation(
    pages: DataFrame, labels: DataFrame, sigmas: float = 1.0, double_suffixes: Sequence[str] = DOUBLE_SUFFIXES
) -> DataFrame:
    """host, n, k, bad_rate, lower_bound and suffix_rate for every host of ``pages`` (page_id, host).

    ``labels`` (page_id, bad) tells outcomes; a page with several labels is bad if one is. n labelled pages of a
    host, k of them bad. A host without labels has its domain's rate.
    """
    marks = labels.filter("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    counted = pages.join(marks, "page_id", "left").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("bigint")), F.lit(0)).alias("k")
    )
    name = without_port(F.col("host"))
    hosts = counted.select(
        "*", domain_of(name, double_suffixes).alias("domain"), suffix_of(name, double_suffixes).alias("suffix")
    )
    # Stored: each of the sums below would join pages and labels again.
    hosts = stored(hosts, "hosts")
    summed = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("domain", "suffix").agg(*summed)
    suffixes = domains.groupBy("suffix").agg(*summed)
    sizes = []
    for level in (suffixes, domains, hosts):
        found = level.filter("n > 0").agg(*_moments()).first()
        sizes.append((found, strength(*(x or 0 for x in found))))
    whole = sizes[0][0]
    rate = ((whole[1] or 0) + 1) / ((whole[0] or 0) + 2)

    def shrunk(prior, size: float) -> Column:
        return (prior * F.lit(size) + F.col("k")) / (F.lit(size) + F.col("n"))

    above = suffixes.select("suffix", shrunk(F.lit(rate), sizes[0][1]).alias("suffix_rate"))
    above = domains.join(above, "suffix").select("domain", "suffix_rate", shrunk(F.col("suffix_rate"), sizes[1][1]).alias("domain_rate"))
    size = F.lit(sizes[2][1]) + F.col("n")
    mean = shrunk(F.col("domain_rate"), sizes[2][1])
    judged = hosts.join(above, "domain").withColumn("bad_rate", mean)
    deviation = F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (size + 1))
    bound = F.col("bad_rate") - sigmas * deviation
    return judged.select("host", "n", "k", "bad_rate", bound.alias("lower_bound"), "suffix_rate")


def judge_pages(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    max_bad: float | None = None,
    sigmas: float = 1.0,
    double_suffixes: Sequence[str] = DOUBLE_SUFFIXES,
    links: DataFrame | None = None,
) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_rate and lower_bound for every row of ``pages`` (page_id, url).

    A rule is a host, with its subdomains, and the start of a path; the longest that fits decides.
    Without one, a page is blocked if the lower bound of its host's bad rate, ``sigmas`` deviations below
    its mean, exceeds the rate of the host's suffix, or ``max_bad`` if that is given.
    A null url, or one without ``://``, has an empty host, which is a host like others. ``labels``
    (page_id, bad) may be empty: all rates are then one half and nothing is blocked by them.
    Repeated rows are judged alike and stay; a null page_id has no label. With ``links`` (page_id, doc_id)
    labels are (doc_id, bad) and tell the outcome of every page made of that document.
    """
    if links is not None:
        labels = links.select("page_id", "doc_id").distinct().join(labels, "doc_id").select("page_id", "bad")
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = host_reputation(rows.select("page_id", "host"), labels, sigmas, double_suffixes)
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    limit = F.col("suffix_rate") if max_bad is None else F.lit(max_bad)
    learned = F.when(F.col("lower_bound") > limit, "block").otherwise("allow")
    return rows.join(known, "host").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, learned).alias("verdict"),
        "bad_rate",
        "lower_bound",
    )
