"""Connected components of a link table, by alternating large and small stars.

Links stay distributed; each round is written to the shared folder, so a lost
executor repeats one round at most.  Every round replaces the links of a node
by links to the smallest node it knows, so that a component becomes a star
around its smallest node in a few rounds.  Smallest neighbours are found by a
pre-aggregated minimum, never by gathering a node's links; the minima are
written before links are joined to them, so that the join has shuffles of its
own and Spark can split those of a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(_least(both).select("u", F.least("u", "m").alias("m")), "links-least")
    joined = both.join(least, "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialize(_least(down), "links-least")
    rest = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link, root being the smallest node of
    its component; nodes that are their own root are left out.  Links from a
    node to itself, repeated links and links with a null end count for nothing."""
    edges = materialize(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "links")
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen, before = now, edges
        large = materialize(_large_star(before), "links")
        edges = materialize(_small_star(large), "links")
        discard(before)
        discard(large)
