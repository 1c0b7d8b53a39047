"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .runtime import Scratch


def _least(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(u, m): the least neighbour of each u. Aggregated before the shuffle, so a hot u is no burden. Written, so that in a join with it
    the rows of a hot u can be split."""
    return scratch.save(edges.groupBy("u").agg(F.min("v").alias("m")), "least")


def _star_shaped(edges: DataFrame) -> bool:
    """Whether each u has one v, and no v is a u."""
    forked = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    chained = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").select("u")
    return forked.unionByName(chained).isEmpty()


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, component): for each node of links (u, v), the smallest node reachable. Nodes without a link are absent.

    Large-star and small-star steps in turn until each node points to its component's smallest; each works by aggregation and
    join, so neither neighbours of a node nor a component are ever gathered in one place. Each round is a written table.
    """
    edges = scratch.save(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while not _star_shaped(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = _least(scratch, both)
        large = scratch.save(both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), "large")
        far = _least(scratch, large)
        small = large.join(far, "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        after = scratch.save(small, "star")
        for old in (edges, near, large, far):
            scratch.drop(old)
        edges = after
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
