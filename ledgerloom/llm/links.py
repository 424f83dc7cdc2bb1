"""Connected components of a link table, by repeated hooking to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.staging import staged


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every larger end has one smaller end, and no smaller end is a larger one elsewhere."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("low_links"), F.lit(0).alias("high_links"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("low_links"), F.lit(1).alias("high_links")))
    nodes = ends.groupBy("node").agg(F.sum("low_links").alias("low"), F.max("high_links").alias("high"))
    return nodes.where("low > 1 or (low > 0 and high > 0)").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node with links that is not its component's smallest node, and that smallest node.

    Each round first hangs every larger neighbour on the smallest node around (large star), then every
    smaller neighbour (small star); the number of rounds grows with the logarithm of the longest path. Both
    stars are one aggregation and one join, so a node with very many links is pre-summed per task and its
    join partition can be split. Rounds end when only stars are left. Links with a null end or from a node to itself join nothing;
    repeated links count once, and an empty table gives no rows.
    """
    edges = staged(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    while not _is_star_forest(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = staged(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
