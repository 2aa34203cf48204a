"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, release


def connected(links: DataFrame) -> DataFrame:
    """(node, part) for the nodes of ``links`` (a, b): part is the smallest node reachable.

    Each round is two aggregations over the remaining edges, written to the shared folder; the number of rounds
    grows with the logarithm of the longest path. Only whether an edge is left to change comes to the driver.
    """
    edges = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("part"))
    while True:
        # large star: larger neighbours of u go to the smallest neighbour
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours of u and u itself go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("x"), "m").where("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v")).distinct()
        after = materialise(small, "stars")
        # settled when every node points at one node that points at none
        ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("out")), F.struct(F.col("v").alias("node"), F.lit(0).alias("out"))))
        settled = after.select(ends.alias("x")).groupBy("x.node").agg(F.count("*").alias("k"), F.sum("x.out").alias("out")).where("out > 1 or out = 1 and k > 1").isEmpty()
        release(edges)
        edges = after
        if settled:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("part"))


def extended(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` of ``connected`` with more ``links`` (a, b): earlier links are stars by now, so a round or two settle them."""
    return connected(parts.select(F.col("node").alias("a"), F.col("part").alias("b")).unionByName(links.select("a", "b")))
