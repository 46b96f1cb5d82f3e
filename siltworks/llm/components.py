"""Connected components by alternating large-star and small-star steps, on written tables.

Each step asks for the least neighbour of a node, an aggregate that workers prepare on their own,
and joins it back to the edges; a star with a third of all nodes is a skewed join, which Spark
splits. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.shared import written


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges (u, v), u > v, that tie each u and its v to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its least node) of all nodes that occur in links; links are integers."""
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = written(links.select(u, v).where("u <> v").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        below, above = F.count_if(F.col("v") < F.col("u")).alias("below"), F.count_if(F.col("v") > F.col("u")).alias("above")
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), below, above), "least")
        # Stars by now: each u has one v, and no v is a u. One table of least neighbours tells that and makes the next step.
        if least.where("below > 1 or (below > 0 and above > 0)").isEmpty():
            break
        edges = written(edges.join(least.select(F.col("u").alias("v"), "m"), "v").select("u", F.col("m").alias("v")), "large-star")
        edges = written(_small_star(edges), "small-star")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
