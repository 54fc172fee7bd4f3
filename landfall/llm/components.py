"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.tables import stored


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it is connected to, for all nodes with an edge.

    ``edges`` has two columns of the same integer type; direction, repeats, loops and rows
    with a null do not matter.  Rounds of star contraction: each node hands its larger
    neighbours, then its smaller ones, to the smallest node around it, until nothing
    changes.  A round never makes more edges than there were, and its table is
    written to the shared folder, so that no task depends on a long lineage.
    """
    a, b = (F.col(c) for c in edges.columns)
    edges = edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges, before = stored(edges), None
    while (now := _fingerprint(edges)) != before:
        before = now
        edges = stored(_round(edges))
    members = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    large = (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )
    small = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(small, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct()
