"""Connected components by alternating large-star and small-star rounds.

DataFrame operations only. Every round rewrites the edges so that each node
points to the smallest node it knows of, until the edges are stars. Edges are
written to the shared folder after each half round; hubs (a star's centre may
hold most edges) go through ``lookup_spread``, so no task gets a whole hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, lookup_spread


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` that has a link to another
    node; ``root`` is the smallest node reachable. Nulls, self-links and
    repeated edges are ignored; no edges give no rows."""
    e = cut_lineage(edges.where(F.col(u).isNotNull() & F.col(v).isNotNull()
                                & (F.col(u) != F.col(v)))
                    .select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).distinct())
    before = _state(e)
    while before[0]:
        # large star: a's neighbours above b move to the smallest neighbour of b
        low = cut_lineage(e.select(F.col("b").alias("b"), F.col("b").alias("m"))
                          .unionByName(e.select(F.col("a").alias("b"), F.col("b").alias("m")))
                          .groupBy("b").agg(F.min("m").alias("m")))
        e = cut_lineage(lookup_spread(e, low, "b", "inner")
                        .select("a", F.col("m").alias("b")).distinct())
        # small star: the smaller neighbours of a, and a itself, join the smallest of them
        low = cut_lineage(e.groupBy("a").agg(F.min("b").alias("m")))
        joined = lookup_spread(e, low, "a", "inner")
        e = cut_lineage(joined.where(F.col("b") != F.col("m"))
                        .select(F.col("b").alias("a"), F.col("m").alias("b"))
                        .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        after = _state(e)
        if after == before:
            break
        before = after
    return (e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
