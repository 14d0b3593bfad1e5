"""Connected components of a table of links, by alternating star operations.

Each round links every node to the least node it knows of; hubs and long chains both shrink in a few rounds, and no
task holds a component: the least neighbour is a partial aggregate, and the links of a hub are joined, not gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laddermill.llm.common import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.filter("v < u")
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if large:
        moved = near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of `links` (u, v: numbers, either way round).

    Links from a node to itself, repeated links and links with a null are ignored. No links: no rows.
    """
    links = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    state = None
    while True:
        links = materialize(_star(_star(links, True), False), "links")
        seen = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    return links.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
