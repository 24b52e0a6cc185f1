"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node.

    Alternating large-star and small-star steps: each node hands its larger neighbours, then
    its smaller ones, to the smallest node it knows. Every step is one aggregation and one
    join, and its result a stored table; the number of rounds grows with the logarithm of
    the longest path. No group is ever collected.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        # e holds each edge once, as (a > b); a star step links neighbours to the smallest one.
        if large:
            both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("a", "m").alias("m"))
        moved = both.join(low, "a")
        if large:
            moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            own = low.where("m < a").select("a", F.col("m").alias("b"))
            moved = moved.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
        return moved.where("a > b").distinct()

    e = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while not e.isEmpty():
        moved = stored(star(star(e, True), False))
        # Both are sets, so they are equal if they are as large and nothing of one is missing in the other.
        same = moved.count() == e.count() and moved.join(e, ["a", "b"], "left_anti").isEmpty()
        e = moved
        if same:
            break
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
