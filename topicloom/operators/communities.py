"""Community links, rollup and stale rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.categories import counted_lists
from ..functions.ids import is_noise, topic_id


def community_links(clusters: DataFrame, day: dt.date) -> DataFrame:
    """``(cluster_id, community_id, timestamp, unclusterized)``: a noise cluster becomes a community
    of its own, marked ``unclusterized`` so that the next run drops it."""
    alone = is_noise(F.col("community_id"))
    return clusters.select(
        "cluster_id", F.when(alone, topic_id(F.col("cluster_id"), F.lit(day))).otherwise(F.col("community_id")).alias("community_id"),
        "timestamp", alone.alias("unclusterized"))


def roll_up(clusters: DataFrame, links: DataFrame) -> DataFrame:
    """One row per community: size, earliest date, counted categories and the most common ones."""
    rows = links.select("cluster_id", "community_id").join(clusters.drop("community_id"), "cluster_id")
    base = rows.groupBy("community_id").agg(F.sum("size").alias("size"), F.min("timestamp").alias("timestamp"),
                                            F.count(F.lit(1)).alias("clusters"))
    counts = (rows.select("community_id", F.inline("categories")).groupBy("community_id", "category")
              .agg(F.sum("n").alias("n")))
    return base.join(counted_lists(counts, "community_id"), "community_id", "left")


def community_tags(clusters: DataFrame, links: DataFrame) -> DataFrame:
    """``(community_id, tag)``, distinct."""
    return (links.select("cluster_id", "community_id").join(clusters.select("cluster_id", "tags"), "cluster_id")
            .select("community_id", F.explode("tags").alias("tag")).distinct())


def stale_links(links: DataFrame, clusters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links to clusters that are gone, and the ids of the communities to delete: those of dead
    links and the temporary ones."""
    dead = links.join(clusters.select("cluster_id"), "cluster_id", "left_anti")
    drop = dead.select("community_id").unionByName(links.where("unclusterized").select("community_id")).distinct()
    return dead, drop
