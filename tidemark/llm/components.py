"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node of ``links``; the component is named by its smallest node.

    Links lead from the larger to the smaller node. Each round points the larger neighbours of a node (large star), then the
    smaller ones (small star), at the smallest of them, until nothing changes; this takes about log(nodes) rounds.
    A round is two aggregations and two equality joins over the links, so a node with many links is one
    row on the aggregated side and can be split on the other. Each round is written to the shared folder. Links with a null end and
    links of a node to itself are ignored.
    """
    ends = F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    edges = materialise(links.filter(f"{left} <> {right}").select(*ends).distinct(), "links")
    state = _fingerprint(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
        found = _fingerprint(edges)
        if found == state:
            break
        state = found
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
