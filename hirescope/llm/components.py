"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirescope.llm.common import materialize


def connected_components(links: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (two long columns ``u`` and
    ``v``); root is the smallest node of the component.

    Each round hangs every node on the smallest neighbour it knows, first
    among all neighbours, then among the smaller ones, and writes the links
    (shared folder), so no lineage grows and a lost executor costs one round.
    The number of rounds grows with the logarithm of the longest chain.  A
    node with very many links is reduced map-side by ``min``; its rows of the
    join are split by adaptive execution.  Links from a node to itself only
    keep that node.  An empty table gives an empty result.
    """
    links = links.select(F.col("u").cast("long"), F.col("v").cast("long"))
    loops = links.where("u = v").select(F.col("u").alias("node"))
    edges = materialize(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    seen = None
    for _ in range(max_rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.union(lower.select("u", F.col("m").alias("v"))).distinct(), name)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    rest = roots.select(F.col("root").alias("node")).union(loops).distinct().join(roots.select("node"), "node", "left_anti")
    return roots.union(rest.select("node", F.col("node").alias("root")))
