"""Connected components of an edge table by alternating large stars and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import staged


def _smallest(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest of each u and its partners; stored, so that a join to it may split hot u."""
    return staged(pairs.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m")), "star-centres")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; root is the smallest node that can be reached.

    ``edges`` has two columns of comparable ids. Loops, repeats and either
    direction are allowed, edges with a null end are left out, and no edges give
    no rows. Each round is stored in the shared folder, so lineage stays short;
    rounds grow with the logarithm of the nodes. The driver sees two numbers a round.
    """
    a, b = edges.columns
    edges = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = staged(edges.distinct(), "edges")
    before = None
    state = _state(edges)
    while state != before and state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.distinct(), "large-stars")
        centre = _smallest(large)
        low = large.join(centre, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(low.unionByName(centre.select("u", F.col("m").alias("v"))).distinct(), "small-stars")
        before, state = state, _state(edges)
    linked = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return linked.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
