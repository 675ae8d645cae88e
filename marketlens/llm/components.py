"""Connected components of a link table by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import stored


def components(links: DataFrame, name: str, max_rounds: int = 50) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns a, b; any orderable type); root is the smallest node.

    Each round hangs larger neighbours under the smallest (large star), then
    smaller ones (small star), until nothing changes.  A node with very many
    links is only ever summed to its minimum and joined (both can be split),
    never gathered.  Rounds are written to the shared folder, so lineage
    stays short.  Raises if ``max_rounds`` don't settle it (they halve the
    depth, so that takes a chain of astronomic length).
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stored(edges, f"{name}-links")

    def state(df: DataFrame) -> tuple:
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(edges)
    for k in range(max_rounds):
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Large star: larger neighbours of u hang under the smallest of u and its neighbours.
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: the smaller neighbours of u, and u, hang under the smallest.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = (large.join(small, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
                 .select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct())
        edges = stored(edges, f"{name}-round{k}")
        now = state(edges)
        if now == before:
            roots = edges.select("v").distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))
        before = now
    raise RuntimeError(f"{max_rounds} rounds did not settle the components")
