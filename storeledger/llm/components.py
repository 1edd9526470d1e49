"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm.support import Scratch


def _least(pairs: DataFrame) -> DataFrame:
    """Every node u with each neighbour v, and the least of u and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").withColumn("m", F.least("u", "m"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """`node`, `component` (the least node reachable) of every node of the edges `u`, `v` (longs).

    Alternating stars: each round hangs the larger neighbours of a node, then the smaller,
    on its least neighbour, until all edges are stars. A node of many edges is one key of a
    pre-aggregated minimum and of a join that adaptive execution splits. Each round is a
    written table. Self-loops and repeated edges are allowed; no edges give no rows.
    """
    edges = scratch.write(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _least(large)  # here v < u, as large() hangs nodes on smaller ones
        hung = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        roots = small.select("u", F.col("m").alias("v"))
        edges = scratch.write(hung.unionByName(roots).distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
