"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges(a, b)``; a component is named by its smallest node.

    Large-star and small-star steps in turn until nothing changes. Neighbours are only ever reduced
    to their minimum (with partial aggregation), never gathered; each step is written to the shared folder. Nothing
    changes any more when each larger node has one edge, to a node that is the smaller one in all its edges.
    """
    pairs = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _stars_only(pairs):
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        pairs = materialize(small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct())
    named = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return named.unionAll(named.select("component", "component").distinct().toDF("node", "component"))


def _stars_only(pairs: DataFrame) -> bool:
    """Whether in the distinct ``pairs(u, v)``, u > v, every u has one v, and no v is a u."""
    ends = pairs.select("u", F.lit(1).alias("up")).unionAll(pairs.select("v", F.lit(0)))
    return ends.groupBy("u").agg(F.sum("up").alias("up"), F.min("up").alias("least")).where("up > 1 or (up = 1 and least = 0)").isEmpty()
