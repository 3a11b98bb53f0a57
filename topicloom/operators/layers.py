"""The two clustering layers over a day's documents and the splits of large topics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import is_noise, noise_id, split_id, topic_id
from ..session import cut
from ..settings import (CLUSTER_FLAT, CLUSTER_SHARED, DOC_CONTENT, DOC_TITLE, EPS_CLUSTER_FLAT,
                        EPS_CLUSTER_SHARED, EPS_DOC_CONTENT, EPS_DOC_TITLE, MIN_SAMPLES, OUTLIER_ALPHA, Metric)
from .dbscan import dbscan
from .ordinal import number_keys, number_within
from .lookup import CategoryPairs
from .points import cluster_points, doc_points
from .profile import modal_flag, oversized


def labelled(members: DataFrame, day: dt.date, start: int = 0) -> DataFrame:
    """``(id, topic)`` of clustered points; topics are numbered from ``start`` by smallest member."""
    numbers = number_keys(members, ["root"]).withColumn(
        "topic", topic_id(F.col("ordinal") + F.lit(start), F.lit(day)))
    return members.join(numbers.select("root", "topic"), "root").select("id", "topic")


def first_layer(docs: DataFrame, categories: CategoryPairs, day: dt.date, *, metric: Metric = DOC_TITLE,
                eps: float = EPS_DOC_TITLE, min_samples: int = MIN_SAMPLES, **sizes) -> DataFrame:
    """``(url, cluster, first_layer)`` for every document; noise gets the day's noise id."""
    found = labelled(dbscan(doc_points(docs), metric, eps, categories, min_samples, **sizes), day)
    return docs.select("url").join(found.withColumnRenamed("id", "url"), "url", "left").select(
        "url", F.coalesce("topic", noise_id(F.lit(day))).alias("cluster"), F.col("topic").isNotNull().alias("first_layer"))


def second_layer(docs: DataFrame, categories: CategoryPairs, day: dt.date, n_clusters: int, *,
                 metric: Metric = DOC_TITLE, eps: float = EPS_DOC_CONTENT, min_samples: int = MIN_SAMPLES,
                 **sizes) -> DataFrame:
    """Cluster the noise of ``docs`` (which carry ``cluster``) with the wider radius:
    ``(url, cluster, second_layer)`` for every document; numbers start at ``n_clusters + 1``."""
    noise = docs.where(is_noise(F.col("cluster")))
    found = labelled(dbscan(doc_points(noise), metric, eps, categories, min_samples, **sizes), day, n_clusters + 1)
    return docs.select("url", "cluster").join(found.withColumnRenamed("id", "url"), "url", "left").select(
        "url", F.coalesce("topic", "cluster").alias("cluster"), F.col("topic").isNotNull().alias("second_layer"))


def split_parts(docs: DataFrame, members: DataFrame, day: dt.date, key: str = "url", part: str = "cluster",
                always: bool = False) -> DataFrame:
    """New ids of split topics: ``(key, old, new)`` for all points of every topic that changed.

    ``members`` are the clusters found inside each topic. A topic that came out as one cluster
    without noise is unchanged, unless ``always``.
    """
    numbers = number_within(members, "part", "root", "sub")
    subs = members.join(numbers, ["part", "root"]).select(F.col("id").alias(key), F.col("part").alias(part), "sub")
    inner = docs.select(key, part).join(subs, [key, part], "left")
    if not always:
        changed = (inner.groupBy(part).agg(F.max("sub").alias("__m"), F.count_if(F.col("sub").isNull()).alias("__z"))
                   .where("__z > 0 or __m > 0").select(part))
        inner = inner.join(changed, part)
    fresh = F.when(F.col("sub").isNull(), noise_id(F.lit(day))).otherwise(split_id(F.col(part), F.col("sub"), F.lit(day)))
    return inner.select(key, F.col(part).alias("old"), fresh.alias("new"))


def split_clusters(docs: DataFrame, categories: CategoryPairs, day: dt.date, **sizes) -> DataFrame:
    """Re-cluster inside every cluster and return ``(url, old, new)`` of the clusters that split.

    Clusters whose documents mostly come from the second layer use the content metric, those mostly
    from the first layer the title metric, others stay. All clusters go through one pass per metric.
    """
    real = docs.where(~is_noise(F.col("cluster")))
    flags = real.groupBy("cluster").agg(modal_flag(F.col("first_layer")).alias("__f"),
                                        modal_flag(F.col("second_layer")).alias("__s"))
    chosen = cut(real.join(flags.where("__f or __s"), "cluster"), "split-docs")
    members = None
    for second, metric, eps in ((False, DOC_TITLE, EPS_DOC_TITLE), (True, DOC_CONTENT, EPS_DOC_CONTENT)):
        found = dbscan(doc_points(chosen.where(F.col("__s") == second), part="cluster"), metric, eps, categories, **sizes)
        members = found if members is None else members.unionByName(found)
    return split_parts(chosen, members, day)


def create_communities(clusters: DataFrame, categories: CategoryPairs, day: dt.date, *, metric: Metric = CLUSTER_SHARED,
                       eps: float = EPS_CLUSTER_SHARED, min_samples: int = MIN_SAMPLES, **sizes) -> DataFrame:
    """``(cluster_id, community_id)`` for every cluster; noise gets the day's noise id."""
    found = labelled(dbscan(cluster_points(clusters), metric, eps, categories, min_samples, **sizes), day)
    return clusters.select("cluster_id").join(found.withColumnRenamed("id", "cluster_id"), "cluster_id", "left").select(
        "cluster_id", F.coalesce("topic", noise_id(F.lit(day))).alias("community_id"))


def split_communities(clusters: DataFrame, categories: CategoryPairs, day: dt.date, alpha: float = OUTLIER_ALPHA,
                      **sizes) -> DataFrame:
    """``(cluster_id, old, new)`` of all clusters in communities whose summed size is an outlier."""
    totals = clusters.groupBy("community_id").agg(F.sum("size").alias("size"))
    big = oversized(totals, "community_id", alpha=alpha, minimum=0).select("community_id")
    chosen = cut(clusters.join(big, "community_id"), "split-communities")
    found = dbscan(cluster_points(chosen, part="community_id"), CLUSTER_FLAT, EPS_CLUSTER_FLAT, categories, **sizes)
    return split_parts(chosen, found, day, "cluster_id", "community_id", always=True)
