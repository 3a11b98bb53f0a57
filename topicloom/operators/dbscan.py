"""Density clustering of points, for any ``min_samples``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, is_empty
from ..settings import MIN_SAMPLES, Metric
from .components import connected_components
from .lookup import CategoryPairs
from .neighbors import ANCHOR_BLOCKS, BLOCK_ROWS, core_neighbours, core_points, flagged_points, links, smallest_roots

#: With at most this many samples the core neighbours of a border point are listed.
LISTED_SAMPLES = 64


def dbscan(points: DataFrame, metric: Metric, eps: float, categories: CategoryPairs,
           min_samples: int = MIN_SAMPLES, **sizes) -> DataFrame:
    """``(part, id, root)`` of clustered points; points left out are noise.

    Neighbours are counted at distance ≤ eps including the point itself. ``root`` is the smallest
    id of the cluster's core points. With two samples every point that has a neighbour is core, so
    clusters are the connected components of the ε-graph and no count is needed. Otherwise core
    points connect, and a border point joins the adjacent cluster with the smallest root.
    """
    if min_samples < 2:
        raise ValueError("min_samples must be at least 2")
    if min_samples == 2:
        return _connected(points, metric, eps, categories, **sizes)

    listed = categories.shared is not None and min_samples <= LISTED_SAMPLES
    many = sizes.get("block_rows", BLOCK_ROWS) * sizes.get("anchor_blocks", ANCHOR_BLOCKS)
    if listed and not is_empty(points.groupBy("part").count().where(F.col("count") > many)):
        return _listed(points, metric, eps, categories, min_samples, **sizes)

    flags = cut(core_points(points, metric, eps, categories, min_samples, **sizes), "core-flags")
    core = points.join(flags.where("core").select("id"), "id", "left_semi")
    joined = _connected(core, metric, eps, categories, **sizes).select("id", "root")
    rooted = cut(core.join(joined, "id", "left").withColumn("root", F.coalesce("root", "id")), "cores")
    loose = points.join(flags.where("not core").select("id"), "id", "left_semi")
    border = smallest_roots(loose, rooted, metric, eps, categories, **sizes)
    return rooted.select("part", "id", "root").unionByName(border)


def _listed(points: DataFrame, metric: Metric, eps: float, categories: CategoryPairs, min_samples: int, **sizes) -> DataFrame:
    """The same with each vector written and sent as rarely as possible, for parts of many blocks."""
    core, loose = flagged_points(points, metric, eps, categories, min_samples, **sizes)
    joined = cut(_connected(core, metric, eps, categories, written=True, **sizes).select("id", "root").distinct(), "roots")
    rooted = core.select("part", "id").join(joined, "id", "left").select("part", "id", F.coalesce("root", "id").alias("root"))
    near = core_neighbours(loose, core, metric, eps, categories, **sizes)
    border = (near.join(joined.withColumnRenamed("id", "core"), "core", "left")
              .groupBy("part", "id").agg(F.min(F.coalesce("root", "core")).alias("root")))
    return rooted.unionByName(border)


def _connected(points: DataFrame, metric: Metric, eps: float, categories: CategoryPairs, **sizes) -> DataFrame:
    found, final = links(points, metric, eps, categories, **sizes)
    found = cut(found.select(F.col("node").alias("u"), F.col("root").alias("v")), "links")
    if final:
        members = found.select(F.col("u").alias("id"), F.col("v").alias("root"))
        members = members.unionByName(members.select(F.col("root").alias("id"), "root").distinct())
    else:
        members = connected_components(found)
    return members.join(points.select("id", "part"), "id").select("part", "id", "root")
