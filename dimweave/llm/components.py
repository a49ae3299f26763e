"""Connected components of an edge table, by alternating large and small stars.

Every round is two joins on grouped minima; nothing is gathered per node, so a node with many
edges is no burden, and the rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import materialize, remove


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node now points to the node's smallest neighbour or itself."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours now point to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node that is not the smallest of its component, with the smallest.

    `edges` has two comparable columns u and v without nulls, in any direction, repeats allowed.
    """
    mark = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    now = materialize(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u <> v")
        .distinct(),
        "edges",
    )
    seen = now.agg(*mark).first()
    while seen[0]:
        stars = materialize(_large_star(now), "edges")
        after = materialize(_small_star(stars), "edges")
        remove(stars)
        remove(now)
        now, before, seen = after, seen, after.agg(*mark).first()
        if seen == before:
            break
    return now
