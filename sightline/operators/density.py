"""Density clusters on a grid, with noise.

A point is *core* if at least ``min_points`` points, itself included, lie within ``eps`` of it; core
points within ``eps`` of each other are in one cluster; a point that is not core joins a cluster with a
core point within ``eps``, or is noise.

The grid's cells have a diagonal of ``eps``, so the points of a cell are all neighbours: a cell of
``min_points`` is settled by its count, and only points of thinner cells are compared with the points
around them.  Clusters are connected components of cells.  Equal points are one point with a weight
from the beginning, so copies cost nothing.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .components import components

DIMENSIONS = 6  # at most; the cells around a cell are 3 to the power of it


def _squared(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x)


def _around(block: str, d: int) -> Column:
    """The 3^d blocks around and including a block of the coarse grid."""
    steps = F.array(*[F.array(*[F.lit(s).cast("long") for s in step]) for step in itertools.product((-1, 0, 1), repeat=d)])
    return F.transform(steps, lambda step: F.zip_with(F.col(block), step, lambda x, y: x + y))


def _close(limit: float):
    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        """The pair of cells, if a point of one is within the limit of a point of the other."""
        out = pa.schema([("u", pa.int64()), ("v", pa.int64())])
        if not len(left) or not len(right):
            return out.empty_table()
        a, b = (np.array(t.column("point").to_pylist(), np.float64) for t in (left, right))
        for i in range(0, len(a), 512):
            for j in range(0, len(b), 4_096):
                gaps = a[i : i + 512, None, :] - b[None, j : j + 4_096, :]
                if (np.einsum("ijk,ijk->ij", gaps, gaps) <= limit).any():
                    first = left.slice(0, 1)
                    return pa.Table.from_arrays([first.column("u").cast(pa.int64()), first.column("v").cast(pa.int64())], schema=out)
        return out.empty_table()

    return step


def density_clusters(df: DataFrame, key: str, features: Sequence[str], eps: float, min_points: int = 15) -> DataFrame:
    """``df`` with ``cluster``, the least ``key`` of a cluster's core points and null for noise, and
    ``is_core``.

    ``key`` is a unique long.  A point near the core points of several clusters joins the one of least
    number.  Rows with a feature that is null or not finite are noise and count for no other.
    No table of all pairs is made: thin cells hold fewer than ``min_points`` points each, and two
    cells are compared, point by point near their common side, only where their first points do not
    show that they belong together.
    """
    d = len(features)
    if not 1 <= d <= DIMENSIONS:
        raise ValueError(f"between 1 and {DIMENSIONS} features")
    side, limit = eps / d**0.5, eps * eps
    values = [F.col(c).cast("double") for c in features]
    whole = F.lit(True)
    for v in values:
        whole = whole & v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    rows = df.withColumn("_point", F.when(whole, F.array(*[F.coalesce(v, F.lit(0.0)) + F.lit(0.0) for v in values])))
    points = rows.where("_point IS NOT NULL").groupBy(F.col("_point").alias("point")).agg(F.min(key).alias("id"), F.count("*").alias("n"))
    points = pin(points.withColumns({
        "cell": F.transform("point", lambda x: F.floor(x / side)), "block": F.transform("point", lambda x: F.floor(x / eps)),
    }))
    full = points.groupBy("cell").agg(F.sum("n").alias("_in_cell"))
    points = pin(points.join(full, "cell").withColumn("dense", F.col("_in_cell") >= min_points).drop("_in_cell"))

    thin = points.where("NOT dense").select(F.col("id").alias("thin"), F.col("point").alias("_own"), F.explode(_around("block", d)).alias("block"))
    near = thin.join(points.select("id", "n", "point", "block"), "block").where(_squared(F.col("_own"), F.col("point")) <= limit)
    counts = near.groupBy("thin").agg(F.sum("n").alias("_near"))
    judged = points.join(counts, points["id"] == counts["thin"], "left").withColumn(
        "core", F.col("dense") | (F.coalesce("_near", F.lit(0)) >= min_points)).drop("thin", "_near")
    judged = pin(judged)
    core = judged.where("core")

    cells = core.groupBy("cell").agg(F.min("id").alias("home"), F.min_by("point", "id").alias("first"), F.min_by("block", "id").alias("block"))
    cells = pin(cells)
    # cells whose points can be within eps lie in blocks next to each other; a block holds whole cells or parts of them
    blocks = core.select("cell", "block").distinct().join(cells.select("cell", "home", "first"), "cell")
    far = blocks.select(F.col("home").alias("v"), F.col("cell").alias("v_cell"), F.col("first").alias("v_first"), "block")
    pairs = blocks.select(F.col("home").alias("u"), F.col("cell").alias("u_cell"), F.col("first").alias("u_first"), F.explode(_around("block", d)).alias("block"))
    apart = F.aggregate(
        F.zip_with("u_cell", "v_cell", lambda x, y: F.greatest(F.abs(x - y) - 1, F.lit(0))), F.lit(0.0), lambda acc, x: acc + x * x)
    pairs = pairs.join(far, "block").where("u < v").where(apart * side * side <= limit * (1 + 1e-12)).drop("block").distinct()
    pairs = pin(pairs.withColumn("sure", _squared(F.col("u_first"), F.col("v_first")) <= limit))

    def beside(own: str, other: str) -> DataFrame:
        """Core points of one cell of a pair that are near enough to the other cell."""
        open_ = pairs.where("NOT sure").select("u", "v", F.col(f"{own}_cell").alias("cell"), F.col(f"{other}_cell").alias("_other"))
        gap = F.zip_with("point", "_other", lambda x, c: F.greatest(c * side - x, x - (c + 1) * side, F.lit(0.0)))
        reach = F.aggregate(gap, F.lit(0.0), lambda acc, x: acc + x * x) <= limit * (1 + 1e-12)
        near_side = open_.join(core.select("cell", "point"), "cell").where(reach)
        # names of its own for each side, which come from the same tables
        return near_side.select(*[F.col(c).alias(c) for c in ("u", "v", "point")])

    met = beside("u", "v").groupBy("u", "v").cogroup(beside("v", "u").groupBy("u", "v")).applyInArrow(_close(limit), "u long, v long")
    links = pairs.where("sure").select("u", "v").unionByName(met)
    named = components(links)
    homes = cells.join(named, cells["home"] == named["id"], "left").select("cell", F.coalesce("component", "home").alias("_cluster"))
    placed = core.join(homes, "cell").select("id", "_cluster")

    edge = judged.where("NOT core").select(F.col("id").alias("_edge"), F.col("point").alias("_own"), F.explode(_around("block", d)).alias("block"))
    held = core.select("id", "point", "block").join(placed, "id")
    joined = edge.join(held, "block").where(_squared(F.col("_own"), F.col("point")) <= limit).groupBy("_edge").agg(F.min("_cluster").alias("_cluster"))
    settled = placed.select("id", "_cluster", F.lit(True).alias("_core")).unionByName(
        joined.select(F.col("_edge").alias("id"), "_cluster", F.lit(False).alias("_core")))
    found = judged.select("id", "point").join(settled, "id").select("point", "_cluster", "_core")
    return rows.join(found, rows["_point"] == found["point"], "left").drop("point", "_point").withColumns({
        "cluster": F.col("_cluster"), "is_core": F.coalesce("_core", F.lit(False)),
    }).drop("_cluster", "_core")
