"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoflow.llm.common import Scratch


def _star(links: DataFrame, scratch: Scratch, name: str, large: bool) -> DataFrame:
    """Large star: a node hands its smallest neighbour (or itself) to its larger neighbours.
    Small star: to its smaller neighbours and itself. ``links``: distinct (a, b), a > b."""
    around = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        around = around.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    # Written and reread, so that the join below has an exchange on both sides that AQE can split or replace by a broadcast.
    least = scratch.save(around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-least")
    met = around.join(least, "u")
    if large:
        out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = met.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = out.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node reachable.

    ``links``: (a, b) of one orderable type, any order, repeats allowed. Each round
    is written to the shared folder; the driver sees two numbers a round.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    edges = scratch.save(edges, "links-0")
    state, k = None, 0
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct()
        state, k = now, k + 1
        wide = scratch.save(_star(edges, scratch, f"large-{k}", True), f"wide-{k}")
        edges = scratch.save(_star(wide, scratch, f"small-{k}", False), f"links-{k}")
