"""Connected components by alternating large-star and small-star steps.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014).
Every step is a minimum per node (combined on the map side) and a join of the
edges with those minima, so a hub with millions of edges never meets in one
task: the minima are cut off by ``checkpoint`` first, which leaves two plain
shuffles that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, root`` for every node that has an edge; root is its component's smallest node.

    Nulls and loops among the edges are ignored; no edges give no rows.
    Node ids are longs.  Repeated edges count once.
    """
    pairs = (
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct()
    )
    pairs = cut_lineage(pairs)
    before = None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        pairs = _small_star(_large_star(pairs))
    return pairs.select(F.col("hi").alias("id"), F.col("lo").alias("root")).union(
        pairs.select(F.col("lo").alias("id"), F.col("lo").alias("root")).distinct()
    )


def _large_star(pairs: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node it knows."""
    least = cut_lineage(
        pairs.select(F.col("hi").alias("u"), F.col("lo").alias("m"))
        .union(pairs.select(F.col("lo").alias("u"), F.col("lo").alias("m")))
        .groupBy("u")
        .agg(F.min("m").alias("m"))
    )
    return cut_lineage(
        pairs.join(least, pairs["lo"] == least["u"]).select("hi", F.col("m").alias("lo")).distinct()
    )


def _small_star(pairs: DataFrame) -> DataFrame:
    """Hang a node and all its smaller neighbours on the smallest of them."""
    least = cut_lineage(pairs.groupBy("hi").agg(F.min("lo").alias("m")))
    hung = pairs.join(least.withColumnRenamed("hi", "u"), F.col("hi") == F.col("u")).where(F.col("lo") != F.col("m"))
    return cut_lineage(
        hung.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        .union(least.select("hi", F.col("m").alias("lo")))
        .distinct()
    )
