"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v") % (1 << 30)), F.lit(0))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(u, v) links -> (node, component): the smallest node reachable, for nodes with a link.

    Only link rows are moved; each round is written to the shared folder.  Rounds grow with
    the logarithm of a component's size.
    """
    a, b = F.col(links.columns[0]), F.col(links.columns[1])
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)).where("u <> v").distinct(), "links")
        after = _state(edges)
        if after == state:
            break
        state = after
    least = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return least.union(edges.select("v", "v").distinct())
