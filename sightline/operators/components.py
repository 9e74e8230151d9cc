"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.session import pin


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of the pairs ``u``, ``v``; component is the least id reachable.

    A large star ties each larger neighbour of a vertex to the vertex's least neighbour, a small
    star does so with the smaller ones; the two alternate until the edges no longer change, after a
    number of rounds that grows with the logarithm of the longest path.  Minima are combined before
    the shuffle, so a vertex with very many neighbours is no hot spot.  Each round is written to the
    shared checkpoint folder.
    """
    edges = pin(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = None
    while before != (now := _mark(edges)):
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")
        ).select("e.u", F.col("e.m").alias("v"))
        edges = pin(small.where("u <> v").distinct())
    return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
