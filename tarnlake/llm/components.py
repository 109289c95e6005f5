"""Connected components of a large graph of links.

Rounds of large-star and small-star: every node links its larger neighbours, then
its smaller ones, to the smallest node it knows.  Stars remain after a number of
rounds that grows with the logarithm of the longest chain.  Each step is a
map-side minimum and one join; both join inputs are stored rows, so that Spark
can split a hub with a large share of the links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tarnlake.session import stage

def _stage_marked(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """``edges`` stored, with a checksum taken during the write."""
    seen = Observation()
    marks = F.count("*").alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(20,0)")).alias("all")
    stored = stage(edges.observe(seen, *marks), name)
    return stored, tuple(seen.get.values())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = stage(both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low")), "star-low")
    larger = both.where("dst > src").join(low, "src")
    return larger.select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = stage(edges.groupBy("src").agg(F.min("dst").alias("low")), "star-low")
    rest = edges.join(low, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return rest.unionByName(low.select("src", F.col("low").alias("dst"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component_id`` for every node of ``src, dst`` links, the smallest node as the id.

    Links from a node to itself and repeated links change nothing; without links
    there are no rows.
    """
    edges = links.where("src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    edges, mark = _stage_marked(edges, "links")
    while mark[0]:
        before = mark
        larger, _ = _stage_marked(_large_star(edges), "large-star")
        edges, mark = _stage_marked(_small_star(larger), "small-star")
        if mark == before:
            break
    nodes = edges.select(F.col("src").alias("node"), F.col("dst").alias("component_id"))
    return nodes.unionByName(edges.select(F.col("dst").alias("node"), F.col("dst").alias("component_id")).distinct())
