"""Point tables: the shape every distance operator works on.

``id``, ``part`` (points of different parts never meet), one column per vector of the metric,
``cats`` and ``shares``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.categories import equal_shares, known, leading_shares

def doc_points(docs: DataFrame, key: str = "url", part: str | None = None,
               title: str = "title_embedding", content: str = "content_embedding",
               categories: str = "categories", keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents as points; ``content`` names the vector used for content distances."""
    cats = known(F.col(categories))
    return docs.select(
        F.col(key).alias("id"), (F.col(part) if part else F.lit("")).alias("part"),
        F.col(title).alias("title_vec"), F.col(content).alias("content_vec"),
        cats.alias("cats"), equal_shares(cats).alias("shares"), *keep)


def cluster_points(clusters: DataFrame, key: str = "cluster_id", part: str | None = None,
                   centroid: str = "centroid_embedding", counted: str = "categories",
                   max_categories: int = 1) -> DataFrame:
    """Clusters (or communities) as points with the shares of their leading categories; one whose members have no
    category at all has no list, which counts as an empty one."""
    return clusters.withColumn("__top", leading_shares(F.col(counted), max_categories)).select(
        F.col(key).alias("id"), (F.col(part) if part else F.lit("")).alias("part"),
        F.col(centroid).alias("centroid_vec"),
        F.coalesce("__top.category", F.array().cast("array<string>")).alias("cats"),
        F.coalesce("__top.share", F.array().cast("array<double>")).alias("shares"))
