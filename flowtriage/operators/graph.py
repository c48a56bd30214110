"""Connected components as DataFrame rounds (used by C5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtriage.runtime import materialise


def connected_components(links: DataFrame, nodes: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, comp): the smallest node of each component, from undirected links (a, b) of longs.

    Alternating star rounds (Kiveris et al. 2014): every node's larger neighbours
    are linked to the smallest node around it, then its smaller ones, until only
    stars are left.  Minima combine map side; each round is a written table.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, mark = materialise(edges, "links"), None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = materialise(large.join(low, "u").select(F.explode(pairs).alias("e")).select("e.u", "e.v").where("u != v").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            stars = edges.select(F.col("u").alias("node"), "v")
            return nodes.join(stars, "node", "left").select("node", F.coalesce("v", "node").alias("comp"))
        mark = now
    raise RuntimeError("connected components did not converge")
