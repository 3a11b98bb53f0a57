"""Assignment of points to existing topics and the choice between old and new topics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.categories import with_category_distance
from ..functions.ids import is_noise
from ..functions.metrics import comparable, weighted
from ..functions.vectors import euclidean
from ..session import BROADCAST_ROWS, BROADCAST_VALUES, cut, rows_within
from ..settings import (CLUSTER_FLAT, CLUSTER_SHARED, DOC_CONTENT, DOC_TITLE, EPS_CLUSTER_FLAT,
                        EPS_CLUSTER_SHARED, EPS_DOC_CONTENT, EPS_DOC_TITLE, Metric)
from .kernel import Block, exact, near
from .lookup import CategoryPairs
from .points import cluster_points, doc_points

#: Rows of each side of a tile when the topics are too many to broadcast.
SIDE_ROWS = 16_384


@dataclass(frozen=True)
class Rule:
    """A point matches a topic when its distance is below ``threshold``, or below the topic's own
    value in the column ``border`` (if any)."""

    metric: Metric
    threshold: float
    border: str | None = None


DOC_RULES = (Rule(DOC_TITLE, EPS_DOC_TITLE, "border0"), Rule(DOC_CONTENT, EPS_DOC_CONTENT, "border1"))
COMMUNITY_RULES = (Rule(CLUSTER_SHARED, EPS_CLUSTER_SHARED), Rule(CLUSTER_FLAT, EPS_CLUSTER_FLAT))

_MATCH = "id string, topic string, distance double, method string"


def best_matches(points: DataFrame, topics: DataFrame, rules: tuple[Rule, ...], categories: CategoryPairs,
                 pick: str = "nearest", broadcast_rows: int = BROADCAST_ROWS, side_rows: int = SIDE_ROWS) -> DataFrame:
    """Per point the best matching topic: ``(id, topic, distance, method)``; points without a match
    are absent. Ties go to the smaller topic id, then to the earlier rule.

    Topics are broadcast when a count proves them small; otherwise both sides are dealt into
    blocks, each pair of blocks yields one candidate per point, and the candidates are reduced.
    """
    if pick not in ("nearest", "farthest"):
        raise ValueError("pick must be 'nearest' or 'farthest'")
    sign = 1.0 if pick == "nearest" else -1.0
    columns = sorted({c for r in rules for c in r.metric.columns})

    def compare(left: pa.Table, right: pa.Table, listed: dict) -> pa.Table:
        a, b = Block(left, columns), Block(right, columns)
        rank = np.full(len(a), np.inf)
        topic = np.full(len(a), -1)
        border = np.zeros(len(a), dtype=bool)
        for rule in rules:
            edge = (right.column(rule.border).to_numpy().astype(float) if rule.border
                    else np.full(len(b), -np.inf))
            edge = np.where(np.isnan(edge), -np.inf, edge)
            bound = np.maximum(edge, rule.threshold)
            for i, j, _, _, terms in near(a, b, rule.metric, listed, bound):
                d = exact(a, b, i, j, rule.metric, terms)
                keep = d < bound[j]
                i, j, d = i[keep], j[keep], d[keep]
                order = np.lexsort((j, sign * d, i))
                i, j, d = i[order], j[order], d[order]
                head = np.ones(len(i), dtype=bool)
                head[1:] = i[1:] != i[:-1]
                i, j, d = i[head], j[head], sign * d[head]
                better = (d < rank[i]) | ((d == rank[i]) & (j < topic[i]))
                i, j, d = i[better], j[better], d[better]
                rank[i], topic[i], border[i] = d, j, sign * d < edge[j]
        hit = np.nonzero(topic >= 0)[0]
        return pa.table({
            "id": pa.array(a.ids[hit], pa.string()), "topic": pa.array(b.ids[topic[hit]], pa.string()),
            "distance": pa.array(sign * rank[hit], pa.float64()),
            "method": pa.array(np.where(border[hit], "border", "regular").tolist(), pa.string())})

    edges = [r.border for r in rules if r.border]
    topics = cut(topics.select("id", *columns, "cats", "shares", *edges), "topics")
    points = points.select("id", *columns, "cats", "shares")
    few = rows_within(topics, broadcast_rows)
    if few == 0:
        return points.sparkSession.createDataFrame([], _MATCH)
    if few is not None and categories.shared is not None:
        head = topics.select(sum((F.size(c) for c in columns), F.lit(0)).alias("n")).first()["n"]
        if few * head <= BROADCAST_VALUES:
            shared, pairs = points.sparkSession.sparkContext.broadcast(topics.toArrow().sort_by("id")), categories.shared

            def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    yield from compare(pa.Table.from_batches([batch]), shared.value, pairs.value).to_batches()
            return points.mapInArrow(scan, _MATCH)

    rows = max(1, math.ceil(points.count() / side_rows))
    cols = max(1, math.ceil(topics.count() / side_rows))

    def dealt(side: DataFrame, own: int, other: int, flag: int) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.lit(own))
        spread = side.withColumn("__b", block).withColumn("__o", F.explode(F.sequence(F.lit(0), F.lit(other - 1))))
        tile = F.concat_ws(":", *(["__b", "__o"] if flag == 0 else ["__o", "__b"]))
        return spread.withColumn("tile", tile).withColumn("side", F.lit(flag)).drop("__b", "__o")

    both = dealt(points, rows, cols, 0).unionByName(dealt(topics, cols, rows, 1), allowMissingColumns=True)

    read = categories.reader()

    def run(table: pa.Table) -> pa.Table:
        table, listed = read(table)
        side = table.column("side")
        return compare(table.filter(pc.equal(side, 0)), table.filter(pc.equal(side, 1)).sort_by("id"), listed)

    candidates = categories.sent(both.withColumn("part", F.lit(""))).groupBy("tile").applyInArrow(run, _MATCH)
    best = F.min(F.struct((F.lit(sign) * F.col("distance")).alias("rank"), "topic", "method")).alias("m")
    return candidates.groupBy("id").agg(best).select(
        "id", F.col("m.topic").alias("topic"), (F.lit(sign) * F.col("m.rank")).alias("distance"),
        F.col("m.method").alias("method"))


def central_points(clusters: DataFrame, key: str = "cluster_id") -> DataFrame:
    """Live clusters as points at their central documents, with their borders."""
    head = clusters.select(key, "central_doc.*", F.col("cluster_borders")[0]["max"]["distance"].alias("border0"),
                           F.col("cluster_borders")[1]["max"]["distance"].alias("border1"))
    return doc_points(head, key, keep=("border0", "border1"))


def assign_documents(docs: DataFrame, clusters: DataFrame, categories: CategoryPairs, *, pick: str = "nearest",
                     use_borders: bool = True, **sizes) -> DataFrame:
    """Documents to live clusters: ``(url, cluster_id, distance, method)``.

    ``use_borders=False`` and ``pick="farthest"`` give the variants listed as Q1 and Q2 in the survey.
    """
    rules = DOC_RULES if use_borders else tuple(Rule(r.metric, r.threshold) for r in DOC_RULES)
    found = best_matches(doc_points(docs), central_points(clusters), rules, categories, pick, **sizes)
    return found.select(F.col("id").alias("url"), F.col("topic").alias("cluster_id"), "distance", "method")


def append_to_communities(clusters: DataFrame, communities: DataFrame, categories: CategoryPairs, **sizes) -> DataFrame:
    """Clusters to live communities: ``(cluster_id, community_id, distance)``, nearest wins."""
    found = best_matches(cluster_points(clusters), cluster_points(communities, "community_id"),
                         COMMUNITY_RULES, categories, **sizes)
    return found.select(F.col("id").alias("cluster_id"), F.col("topic").alias("community_id"), "distance")


def choose_clusters(docs: DataFrame, old: DataFrame, centrals: DataFrame, table: DataFrame) -> DataFrame:
    """Choose between the old and the new cluster of each document: ``(url, cluster, choice)``.

    ``docs`` carries the new ``cluster``, ``old`` is the result of :func:`assign_documents`,
    ``centrals`` holds ``(cluster, central_doc)``. A document that has both keeps the new cluster
    as long as it lies within a threshold of its central document, and goes back otherwise.
    """
    has_new = ~is_noise(F.col("cluster"))
    linked = (docs.select("url", "cluster")
              .join(old.select("url", F.col("cluster_id").alias("old")), "url", "left"))
    contested = linked.where(has_new & F.col("old").isNotNull()).select("url")
    head = centrals.select("cluster", F.col("central_doc.categories").alias("__hc"),
                           F.col("central_doc.title_embedding").alias("__ht"),
                           F.col("central_doc.content_embedding").alias("__hv"))
    pairs = (docs.select("url", "cluster", "categories", "title_embedding", "content_embedding")
             .join(contested, "url").join(head, "cluster")
             .select("url", "categories", "__hc",
                     euclidean(F.col("title_embedding"), F.col("__ht")).alias("__t"),
                     euclidean(F.col("content_embedding"), F.col("__hv")).alias("__c")))
    parts = {"title_vec": F.col("__t"), "content_vec": F.col("__c")}
    near = with_category_distance(pairs, "categories", "__hc", table, "__cat").select(
        "url",
        ((comparable(weighted(DOC_TITLE, parts, F.col("__cat"))) < EPS_DOC_TITLE)
         | (comparable(weighted(DOC_CONTENT, parts, F.col("__cat"))) < EPS_DOC_CONTENT)).alias("__near"))
    back = F.col("old").isNotNull() & (~has_new | ~F.coalesce("__near", F.lit(False)))
    choice = F.when(back, "old").when(has_new, "new").otherwise("none")
    return linked.join(near, "url", "left").select(
        "url", F.when(back, F.col("old")).otherwise(F.col("cluster")).alias("cluster"), choice.alias("choice"))
