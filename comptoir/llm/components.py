"""Connected components of an edge table, as alternating star rounds on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.operators.skew import splittable_join
from comptoir.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node with an edge.

    ``edges`` holds two long columns ``a`` and ``b``; loops, nulls and repeated edges do no harm. Each round
    hangs a node's larger neighbours, then its smaller ones, on the smallest neighbour (large star, small
    star), until only stars are left. Minima are combined inside tasks and joins are many to one, so a node
    with very many edges is no burden to one task; rounds grow with the logarithm of the longest path.
    """
    pair = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    state = _state(pair)
    while state[0]:
        # large star: every larger neighbour goes to the smallest of the neighbours and the node itself
        both = pair.unionByName(pair.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
        large = splittable_join(both.filter("v > u"), least, "u").select(F.col("v").alias("u"), F.col("w").alias("v")).filter("u <> v")
        # small star: every smaller neighbour, and the node, goes to the smallest
        large = cut_lineage(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("w"))
        small = splittable_join(large, least, "u").filter("v <> w").select(F.col("v").alias("u"), F.col("w").alias("v"))
        pair = cut_lineage(least.select("u", F.col("w").alias("v")).unionByName(small).distinct())
        before, state = state, _state(pair)
        if state == before:
            break
    roots = pair.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return pair.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(pair: DataFrame) -> tuple:
    """Changes whenever the edges do."""
    row = pair.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum((F.col("u") % 1000003).cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["x"], row["s"]
