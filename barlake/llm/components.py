"""Connected components of a graph given by its edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .storage import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node of ``edges`` (a, b; long).

    Each round writes the edges to the shared folder, and only their number and a checksum come to the
    driver. The number of rounds grows with the logarithm of the longest chain. Each join is between stored
    tables, so that adaptive execution splits a node with many edges. Loops and repeated edges do no harm.
    """
    edges = stored(_directed(edges.select("a", "b")), "edges")
    before = None
    while (now := _fingerprint(edges)) != before:
        before = now
        edges = stored(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(roots.select("root", "root")).distinct()


def _directed(edges: DataFrame) -> DataFrame:
    """From the larger to the smaller node, each once."""
    return (
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.sum(F.shiftright(mixed, 40))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the smallest node around it."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = stored(least, "least")
    larger = both.filter("b > a").join(least, "a")
    return _directed(larger.select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the smallest of them."""
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    near = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _directed(near.unionAll(least.select("a", F.col("m").alias("b"))))
