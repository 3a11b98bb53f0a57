"""The day's batch, the document corpus and the output rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import is_noise


def keep_first(rows: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """One row per key, the first in the given order. ``min_by`` combines before the shuffle, so
    many copies of one key never meet in one task."""
    columns = rows.columns
    kept = rows.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("__row"))
    return kept.select("__row.*")


def merge_batch(new_docs: DataFrame, backlog_docs: DataFrame) -> DataFrame:
    """New documents before backlog, one row per url, without rows that lack categories."""
    rows = (new_docs.withColumn("source_rank", F.lit(0))
            .unionByName(backlog_docs.withColumn("source_rank", F.lit(1)), allowMissingColumns=True))
    return keep_first(rows, "url", "source_rank").drop("source_rank").dropna(subset=["categories"])


def corpus(batch: DataFrame, clusterized: DataFrame) -> DataFrame:
    """The batch plus the documents of live clusters that are not in it. Documents without a category stay."""
    rest = clusterized.join(batch.select("url"), "url", "left_anti")
    return batch.unionByName(rest, allowMissingColumns=True)


def with_layer_flags(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("first_layer", "second_layer")})


def with_age(rows: DataFrame, day: dt.date) -> DataFrame:
    return rows.withColumn("old_doc", F.col("timestamp") != F.lit(day))


def document_rows(rows: DataFrame, day: dt.date) -> DataFrame:
    """``clusterized_docs`` rows; a document without a cluster counts as unclusterized."""
    return rows.select("url", F.col("cluster").alias("cluster_id"),
                       F.coalesce("timestamp", F.lit(day)).alias("timestamp"),
                       F.coalesce(is_noise(F.col("cluster")), F.lit(True)).alias("unclusterized"))


def orphans(clusters: DataFrame, assigned: DataFrame) -> DataFrame:
    """Cluster rows no document points to."""
    return clusters.join(assigned.select("cluster_id").distinct(), "cluster_id", "left_anti")


def cluster_rows(profiles: DataFrame, categories: DataFrame, labels: DataFrame) -> DataFrame:
    """``clusters`` rows; the uuid follows from the cluster id, so a rerun writes the same rows."""
    digest = F.md5(F.col("cluster"))
    uuid = F.concat_ws("-", *[F.substring(digest, s, n) for s, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return (profiles.join(categories, "cluster", "left").join(labels, "cluster", "left")
            .select(uuid.alias("uuid"), F.col("cluster").alias("cluster_id"), "cluster_label", "timestamp",
                    "centroid_embedding", "central_doc", "cluster_borders", "tags", "categories",
                    "most_common_categories"))
