"""Connected components of a thin table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _least(links: DataFrame) -> DataFrame:
    """Per node, the least of itself and its neighbours (counted per task first)."""
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component: the least reachable node.

    Each round hangs greater neighbours on the least one (large star), then
    lesser ones (small star); links shrink to stars in a number of rounds that
    grows with the logarithm of the longest path. Every round is stored, so
    nothing but the present links has to be computed anew after a loss. Self
    links and null ends are left out; no links give an empty table.
    """
    now = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        large = stored(large, "links")
        small = large.join(_least(large), "u")
        now = stored(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct(),
            "links",
        )
        row = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(centres)
