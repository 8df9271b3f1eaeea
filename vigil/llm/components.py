"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a groupBy-min (summed up map-side, so a node with very many links
is no hot task) and a join back; the links stay in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.scratch import stored


def _least_neighbour(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; component is its least reachable node.

    ``links`` has two columns of ids. Self links, repeated links, either
    direction and an empty table are fine; rows with a null are ignored.
    """
    a, b = (F.col(f"`{c}`") for c in links.columns)
    now = links.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now = stored(now, "links")
    while not _all_stars(now):
        # large star: neighbours above u go to the least node around u
        both = now.union(now.select("v", "u"))
        least = _least_neighbour(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its neighbours below it go to the least of them
        least = _least_neighbour(large)
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u != v").distinct()
        now = stored(small, "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())


def _all_stars(links: DataFrame) -> bool:
    """Whether each u has one link, to a node that links to no other."""
    ends = links.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up = 1 and down = 1").isEmpty()
