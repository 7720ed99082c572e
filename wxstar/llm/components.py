"""Connected components of a table of links, by alternating star steps.

Every node first points all its larger neighbours at its smallest neighbour (large
star), then all smaller ones and itself at the smallest (small star); the links turn into one star per
component in a logarithmic number of rounds. Each step is a grouped minimum (combined
before the shuffle) and a join; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxstar.llm.common import discard, materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (u, v) with u > v."""
    if large:
        near = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; the root is the least node of the component."""
    now = materialize(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == state or not mark[0]:
            break
        state = mark
        later = materialize(_star(_star(now, True), False), "links")
        discard(now)
        now = later
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
