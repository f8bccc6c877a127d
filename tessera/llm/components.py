"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the node's smallest neighbour."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    least = least.select("u", F.least("u", "least").alias("least"))
    return (
        both.filter("v > u").join(least, "u")
        .select(F.col("v").alias("hi"), F.col("least").alias("lo"))
        .filter("hi != lo").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    lower = edges.join(least, "hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return (
        lower.unionAll(least.select("hi", F.col("least").alias("lo")))
        .filter("hi != lo").distinct()
    )


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("hi", "lo")
    return tuple(edges.agg(
        F.count(F.lit(1)), F.sum(mixed.bitwiseAND(F.lit((1 << 40) - 1))), F.bit_xor(mixed)
    ).first())


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b); a component is its smallest node.

    Each round is written to the shared folder, which cuts its lineage. Nodes without links, and
    links of a node to itself, give no rows. A node with many links costs one row per link in
    joins that adaptive execution can split.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .filter("hi != lo").distinct()
    )
    before = _state(edges)
    while before[0]:
        edges = stored(_small_star(stored(_large_star(edges))))
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component"))
    ).distinct()
