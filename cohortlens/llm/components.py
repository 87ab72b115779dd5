"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")


def _print(edges: DataFrame) -> tuple:
    """Count and order-free digest of a set of edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``edges`` (a, b: long) to (node, component): the smallest node that links lead to, for every node of an edge.

    Each round links every node's larger neighbours to its smallest neighbour, then every node and its smaller
    neighbours to the smallest of them. Minima are aggregated in each task before the shuffle and joined back, so a node
    with very many links is never gathered. Each round's edges are a written table.
    """
    current = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _print(current)
    for _ in range(rounds):
        ways = _both_ways(current)
        lowest = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.where("v > u").join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # every edge now points to a smaller node
        smallest = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.select(F.col("a").alias("u"), "b").join(smallest, "u").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        current = materialise(small.union(smallest.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        now = _print(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"links have not settled after {rounds} rounds")
    # stars: every node but the smallest points to it
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
