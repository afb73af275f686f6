"""Connected components of an edge table by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for the nodes of ``edges`` (``u, v``: long); ``comp`` is a node of the
    component, the same for all its members.

    Each round hooks every node to its smallest neighbour, follows two pointers, and contracts
    the edges to the ends' new names; the number of rounds is logarithmic in the longest chain.
    Every table is written to the shared folder, so a lost executor costs a round at most.
    """
    live = edges.filter("u <> v")
    live = materialise(live.select("u", "v").union(live.select("v", "u")).distinct(), "edges", few_files=True)
    labels = materialise(live.select(F.col("u").alias("node"), F.col("u").alias("comp")).distinct(), "labels", few_files=True)
    while not live.isEmpty():
        parent = live.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).select("c", F.least("c", "m").alias("p"))
        up = parent.select(F.col("c").alias("c2"), F.col("p").alias("p2"))
        hop = materialise(parent.join(up, parent["p"] == up["c2"], "left").select(
            "c", F.coalesce("p2", "p").alias("to")), "hops", few_files=True)
        labels = materialise(labels.join(hop, labels["comp"] == hop["c"], "left").select(
            "node", F.coalesce("to", "comp").alias("comp")), "labels", few_files=True)
        hu, hv = hop.select(F.col("c").alias("u"), F.col("to").alias("tu")), hop.select(F.col("c").alias("v"), F.col("to").alias("tv"))
        live = materialise(live.join(hu, "u").join(hv, "v").select(F.col("tu").alias("u"), F.col("tv").alias("v")).filter(
            "u <> v").distinct(), "edges", few_files=True)
    return labels
