"""Reads of documents and result tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import first_value, is_noise, midnight
from ..operators.profile import centroids, topic_sizes
from ..session import is_empty
from ..settings import DOC_SCHEMA, TTL_DAYS


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOC_SCHEMA).parquet(path)


def read_table(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A catalog table, or an empty one with the right columns when it does not exist."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def daily_documents(docs: DataFrame, day: dt.date, column: str = "date_created") -> DataFrame:
    """Documents created on ``day``; the range filter reaches the scan."""
    return docs.where((F.col(column) >= F.lit(day)) & (F.col(column) < F.lit(day + dt.timedelta(days=1))))


def unwrap_fields(hits: DataFrame, fields: list[str]) -> DataFrame:
    """Multi-valued fields of search hits to their first value."""
    return hits.withColumns({f: first_value(F.col(f)) for f in fields})


def with_midnight(hits: DataFrame, column: str = "date_created") -> DataFrame:
    """``timestamp`` as a date from the ISO text of ``column``."""
    return hits.withColumn("timestamp", midnight(F.col(column)).cast("date"))


def documents_by_url(docs: DataFrame, urls: DataFrame) -> DataFrame:
    return docs.join(urls.select("url"), "url", "left_semi")


def live_clusters(clusters: DataFrame, day: dt.date, inclusive: bool = False, ttl: int = TTL_DAYS) -> DataFrame:
    """Clusters inside the time to live. The document stage excludes the boundary day, the
    community stage includes it."""
    limit = F.lit(day - dt.timedelta(days=ttl))
    return clusters.where((F.col("timestamp") >= limit) if inclusive else (F.col("timestamp") > limit))


def cluster_documents(assigned: DataFrame, clusters: DataFrame) -> DataFrame:
    """Document rows of the given clusters."""
    return assigned.join(clusters.select("cluster_id"), "cluster_id", "left_semi")


def backlog(assigned: DataFrame, docs: DataFrame, day: dt.date, ttl: int = TTL_DAYS) -> DataFrame:
    """Bodies of recent documents that no cluster took."""
    open_ = assigned.where((F.col("timestamp") > F.lit(day - dt.timedelta(days=ttl))) & F.col("unclusterized"))
    return open_.select("url", "cluster_id").join(docs, "url")


def with_sizes(clusters: DataFrame, assigned: DataFrame) -> DataFrame:
    """Clusters with their number of documents; noise and empty clusters are dropped."""
    return clusters.join(topic_sizes(assigned), "cluster_id").where(~is_noise(F.col("cluster_id")))


def live_links(links: DataFrame, day: dt.date, ttl: int = TTL_DAYS) -> DataFrame:
    return links.where(F.col("timestamp") >= F.lit(day - dt.timedelta(days=ttl)))


def hydrated_communities(communities: DataFrame, links: DataFrame, clusters: DataFrame) -> DataFrame:
    """Communities with the mean centroid of their clusters; incomplete ones are dropped."""
    members = links.select("community_id", "cluster_id").join(clusters.select("cluster_id", "centroid_embedding"), "cluster_id")
    means = centroids(members, "community_id", "centroid_embedding")
    return communities.join(means, "community_id").dropna(subset=["centroid_embedding", "categories"])


def cluster_titles(assigned: DataFrame, docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """``(cluster_id, url, title)`` of the documents of a set of clusters."""
    return cluster_documents(assigned.select("url", "cluster_id"), clusters).join(docs.select("url", "title"), "url")


def require_complete(expected: DataFrame, found: DataFrame, key: str, what: str) -> None:
    """Raise when a key of ``expected`` is missing from ``found``."""
    missing = expected.select(key).join(found.select(key), key, "left_anti").limit(1).take(1)
    if missing:
        raise ValueError(f"{what}: {key} {missing[0][0]!r} is missing")


def require_unique(rows: DataFrame, key: str, what: str) -> None:
    twice = rows.groupBy(key).count().where("count > 1")
    if not is_empty(twice):
        raise ValueError(f"{what}: {key} is not unique")
