"""One query per operator over the test tables; see ``oracles`` for the SQL twins."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors
from ..functions.categories import leading_shares, with_category_distance, with_shared_category_term
from ..functions.ids import id_day, id_label, is_noise, midnight, topic_id
from ..functions.metrics import comparable, weighted
from ..functions.responses import community_label, response_label, response_tags
from ..operators import assign, batch, communities, hierarchy, labels, layers, neighbors, profile
from ..operators.dbscan import dbscan
from ..operators.lookup import share_categories
from ..operators.ordinal import number_keys
from ..operators.points import doc_points
from ..session import is_empty, scratch_root
from ..settings import (CLUSTER_FLAT, CLUSTER_SHARED, DOC_CONTENT, DOC_SCHEMA, DOC_TITLE,
                        EPS_DOC_TITLE)
from ..sinks import store
from ..sources import tables
from ..sources.feeds import category_feed, cluster_feed, doc_feed

Query = Callable[[SparkSession, str], DataFrame]
DAY = dt.date(2024, 1, 30)


def six(c: Column) -> Column:
    return F.round(c, 6) + F.lit(0.0)


# -- closed-form state over the feeds ------------------------------------------------------------

def _topic() -> Column:
    """Topic of a document in the state before the reference day; loose documents are noise."""
    loose = (F.col("b") > 0) & (F.col("b") % 3 == 2) & (F.col("doc_id") % 2 == 1)
    return F.when(loose, F.lit("cl_b-1")).otherwise(F.concat(F.lit("cl_b"), F.col("b").cast("string")))


def topics(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with a ``cluster``."""
    return doc_feed(spark, sf).withColumn("cluster", _topic())


def history(spark: SparkSession, sf: str) -> DataFrame:
    """Documents before the reference day, as clusterized."""
    rows = topics(spark, sf).where(F.col("timestamp") < F.lit(DAY))
    return rows.withColumn("cluster_id", F.col("cluster")).withColumn("unclusterized", is_noise(F.col("cluster")))


def mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in clusters that hold several topics each, with layer flags."""
    g = F.col("b") % 5
    return (doc_feed(spark, sf).withColumn("cluster", F.concat(F.lit("mix_"), g.cast("string")))
            .withColumn("first_layer", g.isin(0, 1, 3) & (F.col("doc_id") % 4 != 0))
            .withColumn("second_layer", g.isin(1, 4) & (F.col("doc_id") % 4 != 1)))


def links_state(spark: SparkSession, sf: str) -> DataFrame:
    """Existing links of the older clusters, one of them to a cluster that is gone per community."""
    feed = cluster_feed(spark, sf).where(F.col("timestamp") < F.lit(DAY - dt.timedelta(days=20)))
    community = F.concat(F.lit("co_"), F.col("k").cast("string"))
    live = feed.select("cluster_id", community.alias("community_id"), "timestamp", (F.col("g") % 5 == 0).alias("unclusterized"))
    dead = feed.groupBy("k").agg(F.max("timestamp").alias("timestamp")).select(
        F.concat(F.lit("dead_"), F.col("k").cast("string")).alias("cluster_id"), community.alias("community_id"),
        "timestamp", F.lit(False).alias("unclusterized"))
    return live.unionByName(dead)


def communities_state(spark: SparkSession, sf: str) -> DataFrame:
    """Communities rolled up from the links."""
    return communities.roll_up(cluster_feed(spark, sf), links_state(spark, sf))


def grouped(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters in closed-form communities."""
    return cluster_feed(spark, sf).withColumn("community_id", F.concat(F.lit("co_"), F.col("k").cast("string")))


def lead_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Every document beside the first document of its bucket."""
    feed = doc_feed(spark, sf)
    lead = feed.groupBy("b").agg(F.min_by(F.struct("title_embedding", "content_embedding", "categories"), "url").alias("h"))
    # a bucket is a remainder, so there are a few dozen, and the largest holds a fifth of the documents
    return feed.join(F.broadcast(lead), "b")


# -- sources ---------------------------------------------------------------------------------------

def daily_scan(spark, sf):
    docs = doc_feed(spark, sf)
    return tables.daily_documents(docs, DAY, "timestamp").select(
        "url", "timestamp", F.char_length("title").alias("title_chars"), F.size("categories").alias("n_categories"))


def doc_lookup(spark, sf):
    urls = spark.read.parquet(f"{sf}/labels.parquet").select(F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"))
    return tables.documents_by_url(doc_feed(spark, sf), urls).select("url", "lang", "timestamp")


def unwrap_hits(spark, sf):
    hits = doc_feed(spark, sf).select(
        F.array("url").alias("url"), F.when(F.col("doc_id") % 7 != 0, F.array("title", "lang")).otherwise(F.array().cast("array<string>")).alias("title"),
        F.array(F.concat(F.col("timestamp").cast("string"), F.lit("T10:11:12.345Z"))).alias("date_created"))
    rows = tables.with_midnight(tables.unwrap_fields(hits, ["url", "title", "date_created"]))
    return rows.select("url", "title", "timestamp")


def midnights(spark, sf):
    events = spark.read.parquet(f"{sf}/orders.parquet")
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T23:59:59.9Z"))
    return events.select("o_orderkey", midnight(text).cast("date").alias("day"))


def live_clusters_ttl(spark, sf):
    feed = cluster_feed(spark, sf).select("cluster_id", "timestamp")
    strict = tables.live_clusters(feed, DAY).withColumn("stage", F.lit("documents"))
    return strict.unionByName(tables.live_clusters(feed, DAY, inclusive=True).withColumn("stage", F.lit("communities")))


def cluster_docs(spark, sf):
    live = tables.live_clusters(cluster_feed(spark, sf), DAY).select(F.concat(F.lit("cl_b"), F.col("k").cast("string")).alias("cluster_id")).distinct()
    return tables.cluster_documents(history(spark, sf), live).select("url", "cluster_id")


def missing_clusters(spark, sf):
    """Completeness check: topics of documents that the cluster feed lacks."""
    have = cluster_feed(spark, sf).select(F.concat(F.lit("cl_b"), F.col("k").cast("string")).alias("cluster_id"))
    docs = history(spark, sf).select("cluster_id").distinct()
    return docs.join(have, "cluster_id", "left_anti")


def backlog_ttl(spark, sf):
    rows = history(spark, sf)
    return tables.backlog(rows.select("url", "cluster_id", "timestamp", "unclusterized"),
                          doc_feed(spark, sf).select("url", "title", "lang"), DAY, 4).select("url", "cluster_id", "title", "lang")


def cluster_sizes(spark, sf):
    rows = history(spark, sf)
    clusters = rows.groupBy("cluster_id").agg(F.min("timestamp").alias("timestamp"))
    return tables.with_sizes(clusters, rows).select("cluster_id", "timestamp", "size")


def community_links(spark, sf):
    links = tables.live_links(links_state(spark, sf), DAY).where(~F.col("unclusterized"))
    feed = cluster_feed(spark, sf).select("cluster_id", "k")
    return feed.join(links.select("cluster_id"), "cluster_id", "left_anti")


def community_hydration(spark, sf):
    rows = tables.hydrated_communities(communities_state(spark, sf), links_state(spark, sf), cluster_feed(spark, sf))
    return rows.select("community_id", "size", F.posexplode("centroid_embedding").alias("i", "v")).withColumn("v", six(F.col("v")))


def cluster_titles(spark, sf):
    rows = history(spark, sf)
    wanted = rows.groupBy("cluster_id").count().where("count > 15")
    return tables.cluster_titles(rows, doc_feed(spark, sf), wanted).select("cluster_id", "url", "title")


# -- batch -------------------------------------------------------------------------------------------

def merge_batch(spark, sf):
    docs = doc_feed(spark, sf).select("url", "lang", "timestamp", F.when(F.col("doc_id") % 29 != 0, F.col("categories")).alias("categories"))
    new = docs.where(F.col("timestamp") == F.lit(DAY)).withColumn("origin", F.lit("new"))
    late = docs.where(F.col("timestamp") >= F.lit(DAY - dt.timedelta(days=1))).withColumn("origin", F.lit("backlog"))
    return batch.merge_batch(new, late).select("url", "timestamp", "origin", F.size("categories").alias("n_categories"))


def dedupe_keep_first(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return batch.keep_first(docs.select("text", "doc_id", "lang", "n_chars"), "text", "n_chars", "doc_id").select("doc_id", "lang", "n_chars")


def corpus(spark, sf):
    docs = topics(spark, sf).select("url", "cluster", "timestamp", "categories")
    now = docs.where(F.col("timestamp") == F.lit(DAY)).withColumn("first_layer", F.lit(True))
    rows = batch.with_layer_flags(batch.corpus(now, docs).withColumn("second_layer", F.lit(None).cast("boolean")))
    return batch.with_age(rows, DAY).select("url", "cluster", "first_layer", "second_layer", "old_doc")


def document_rows(spark, sf):
    rows = topics(spark, sf).withColumn("cluster", F.when(F.col("doc_id") % 13 != 0, F.col("cluster")))
    rows = rows.withColumn("timestamp", F.when(F.col("doc_id") % 17 != 0, F.col("timestamp")))
    return batch.document_rows(rows, DAY)


def orphans(spark, sf):
    clusters = cluster_feed(spark, sf).select(F.concat(F.lit("cl_b"), F.col("g").cast("string")).alias("cluster_id"), "g").distinct()
    return batch.orphans(clusters, history(spark, sf))


# -- functions ---------------------------------------------------------------------------------------

def distances_vec(spark, sf):
    x, y = F.col("title_embedding"), F.col("h.title_embedding")
    return lead_pairs(spark, sf).select(
        "url", six(vectors.euclidean(x, y)).alias("euclidean"), six(vectors.manhattan(x, y)).alias("manhattan"),
        six(vectors.cosine_distance(x, y)).alias("cosine_distance"), six(vectors.cosine_similarity(x, y)).alias("cosine_similarity"))


def _doc_distances(spark, sf) -> DataFrame:
    pairs = lead_pairs(spark, sf).withColumn("hc", F.col("h.categories"))
    return with_category_distance(pairs, "categories", "hc", category_feed(spark), "cat")


def category_distance(spark, sf):
    return _doc_distances(spark, sf).select("url", six(F.col("cat")).alias("distance"))


def _doc_distance(metric) -> Query:
    def query(spark, sf):
        parts = {"title_vec": vectors.euclidean(F.col("title_embedding"), F.col("h.title_embedding")),
                 "content_vec": vectors.euclidean(F.col("content_embedding"), F.col("h.content_embedding"))}
        return _doc_distances(spark, sf).select("url", comparable(weighted(metric, parts, F.col("cat"))).alias("distance"))
    return query


def cluster_distance(spark, sf):
    feed = cluster_feed(spark, sf).withColumn("top", leading_shares(F.col("categories")))
    lead = feed.groupBy("k").agg(F.min_by(F.struct("centroid_embedding", "top"), "cluster_id").alias("h"))
    pairs = feed.join(lead, "k").withColumn("htop", F.col("h.top"))
    gap = {"centroid_vec": vectors.euclidean(F.col("centroid_embedding"), F.col("h.centroid_embedding"))}
    table = category_feed(spark)
    both = with_shared_category_term(with_shared_category_term(pairs, "top", "htop", table, True, "t1"), "top", "htop", table, False, "t2")
    return both.select("cluster_id", comparable(weighted(CLUSTER_SHARED, gap, F.col("t1"))).alias("shared"),
                       comparable(weighted(CLUSTER_FLAT, gap, F.col("t2"))).alias("flat"))


def cluster_ids(spark, sf):
    topic = topic_id(F.col("b"), F.col("timestamp"))
    return doc_feed(spark, sf).select("url", topic.alias("topic"), id_day(topic).alias("day_part"), id_label(topic).alias("label_part"))


_RESPONSE = """case doc_id % 6
  when 0 then concat('cluster label: ', lang, ' ', source, chr(10), 'cluster tags: ', lang, ', ', source)
  when 1 then concat('Cluster label: "', source, '"', chr(10), 'Cluster tags: [', lang, ' , ', source, ']')
  when 2 then concat('- ', source, chr(10), '- "', lang, ',', source, '"')
  when 3 then text
  when 4 then source
  else concat('"', lang, ' cluster label: ', source, '"', chr(10), '-cluster tags: [', n_chars, ']') end"""

_COMMUNITY_RESPONSE = """case doc_id % 5
  when 0 then concat('COMMUNITY: ', source) when 1 then concat('Community: - "', source, ' ', lang, '"')
  when 2 then text when 3 then concat('- ', source) else concat('"', text, '"') end"""


def parse_labels(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").withColumn("r", F.expr(_RESPONSE.replace("chr(10)", "char(10)")))
    return rows.select("doc_id", response_label(F.col("r")).alias("label"), F.array_join(response_tags(F.col("r")), "|").alias("tags"))


def parse_community_label(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").withColumn("r", F.expr(_COMMUNITY_RESPONSE))
    return rows.select("doc_id", community_label(F.col("r")).alias("label"))


# -- clustering --------------------------------------------------------------------------------------

def eps_edges_m1(spark, sf):
    found = neighbors.copy_edges(doc_points(doc_feed(spark, sf)), DOC_TITLE, EPS_DOC_TITLE, share_categories(category_feed(spark)))
    return found.drop("part")


def edges_wide_vocabulary(spark, sf):
    """The edges of ``eps_edges_m1`` over 400 variants of each name, all as far apart as their names: 4,800 names and
    millions of listed pairs, which go to the tiles instead of into a broadcast."""
    variants = 400
    own = F.pmod(F.xxhash64("title_vec"), F.lit(variants)).cast("string")
    points = doc_points(doc_feed(spark, sf))
    points = points.withColumn("__v", own).withColumn("cats", F.transform("cats", lambda c: F.concat(c, F.lit("#"), F.col("__v")))).drop("__v")
    every = F.sequence(F.lit(0), F.lit(variants - 1))
    table = (category_feed(spark).repartition(8).withColumn("i", F.explode(every)).withColumn("j", F.explode(every))
             .select(F.concat_ws("#", "first_category", "i").alias("first_category"), F.concat_ws("#", "second_category", "j").alias("second_category"), "distance"))
    found = neighbors.copy_edges(points, DOC_TITLE, EPS_DOC_TITLE, share_categories(table))
    return found.drop("part")


def own_distance_edges(spark, sf):
    """The caller's own metric: Euclidean title distance, half as much for equal category lists."""
    def own(x: Column, y: Column) -> Column:
        gap = vectors.euclidean(x["title_vec"], y["title_vec"])
        return F.when(x["cats"] == y["cats"], gap * 0.9).otherwise(gap)
    gate = DOC_TITLE
    found = neighbors.eps_edges(doc_points(doc_feed(spark, sf)), gate, 0.4, share_categories(category_feed(spark)), distance=own)
    return found.select("src", "dst", "distance")


def neighbor_counts(spark, sf):
    found = neighbors.neighbor_counts(doc_points(doc_feed(spark, sf)), DOC_TITLE, EPS_DOC_TITLE, share_categories(category_feed(spark)))
    return found.select(F.col("id").alias("url"), "n")


def dbscan_layer1(spark, sf):
    return layers.first_layer(doc_feed(spark, sf), share_categories(category_feed(spark)), DAY)


def dbscan_layer2(spark, sf):
    docs = topics(spark, sf).withColumn("cluster", F.when(F.col("b") % 3 == 0, F.lit("t_1")).otherwise(F.lit("t_-1")))
    return layers.second_layer(docs, share_categories(category_feed(spark)), DAY, 7)


def _dbscan_min(samples: int) -> Query:
    def query(spark, sf):
        found = dbscan(doc_points(doc_feed(spark, sf)), DOC_TITLE, EPS_DOC_TITLE, share_categories(category_feed(spark)), samples)
        numbers = number_keys(found, ["root"], "label")
        return found.join(numbers, "root").select(F.col("id").alias("url"), "label")
    return query


def split_clusters(spark, sf):
    return layers.split_clusters(mixed(spark, sf), share_categories(category_feed(spark)), DAY)


# -- aggregates --------------------------------------------------------------------------------------

def centroids(spark, sf):
    means = profile.centroids(topics(spark, sf), "cluster", "content_embedding", "m")
    return means.select("cluster", F.posexplode("m").alias("i", "v")).withColumn("v", six(F.col("v")))


def central_docs(spark, sf):
    docs = topics(spark, sf)
    found = profile.central_documents(docs, profile.centroids(docs, "cluster", "content_embedding"))
    return found.select("cluster", "url", "distance")


def _border_columns(rows: DataFrame) -> list[Column]:
    out = []
    for m in (0, 1):
        edge = F.col("cluster_borders")[m]
        out += [edge["min"]["url"].alias(f"min_url{m}"), edge["min"]["distance"].alias(f"min{m}"),
                edge["max"]["url"].alias(f"max_url{m}"), edge["max"]["distance"].alias(f"max{m}"),
                six(edge["avg"]).alias(f"avg{m}")]
    return out


def borders(spark, sf):
    docs = topics(spark, sf)
    central = profile.central_documents(docs, profile.centroids(docs, "cluster", "content_embedding"))
    rows = profile.borders(profile.with_central_distances(docs, central, category_feed(spark)))
    return rows.select("cluster", *_border_columns(rows))


def profiles(spark, sf):
    rows = profile.profiles(topics(spark, sf), category_feed(spark))
    return rows.select("cluster", "label", "timestamp", "size", F.col("central_doc.url").alias("central_url"),
                       six(vectors.norm(F.col("centroid_embedding"))).alias("centroid_norm"), *_border_columns(rows))


def cluster_rows(spark, sf):
    docs = topics(spark, sf)
    rows = batch.cluster_rows(profile.profiles(docs, category_feed(spark)), profile.category_profile(docs),
                              labels.labels_from_titles(docs, "cluster"))
    return rows.select("uuid", "cluster_id", "cluster_label", "timestamp", F.col("central_doc.url").alias("central_url"),
                       F.array_join("tags", "|").alias("tags"), F.array_join("most_common_categories", "|").alias("top"))


def top_categories(spark, sf):
    rows = profile.category_profile(topics(spark, sf))
    return rows.select("cluster", F.array_join("most_common_categories", "|").alias("top"),
                       F.array_join(F.transform("categories", lambda e: F.concat_ws(":", e["category"], e["n"].cast("string"))), "|").alias("counted"))


def category_shares(spark, sf):
    rows = cluster_feed(spark, sf).select("cluster_id", F.explode(leading_shares(F.col("categories"), 2)).alias("t"))
    return rows.select("cluster_id", F.col("t.category").alias("category"), six(F.col("t.share")).alias("share"))


def size_outliers(spark, sf):
    found = profile.oversized(profile.topic_sizes(topics(spark, sf), "cluster"), "cluster")
    return found.select("cluster", "size", six(F.col("threshold")).alias("threshold"))


def modal_layer(spark, sf):
    return mixed(spark, sf).groupBy("cluster").agg(profile.modal_flag(F.col("first_layer")).alias("first_layer"),
                                                   profile.modal_flag(F.col("second_layer")).alias("second_layer"))


# -- assignment --------------------------------------------------------------------------------------

def _live(spark, sf) -> DataFrame:
    docs = history(spark, sf).where(~is_noise(F.col("cluster")))
    return profile.profiles(docs, category_feed(spark)).withColumnRenamed("cluster", "cluster_id")


def _assign(**how) -> Query:
    def query(spark, sf):
        return assign.assign_documents(doc_feed(spark, sf), _live(spark, sf), share_categories(category_feed(spark)), **how)
    return query


def pick_best(spark, sf):
    docs = doc_feed(spark, sf).withColumn("cluster", F.when(F.col("b") % 4 == 3, F.lit("nw_-1")).otherwise(
        F.concat(F.lit("nw_"), (F.col("b") % 11).cast("string"))))
    table = category_feed(spark)
    old = assign.assign_documents(docs, _live(spark, sf), share_categories(table))
    central = profile.central_documents(docs, profile.centroids(docs, "cluster", "content_embedding"))
    heads = docs.join(central.select("cluster", "url"), ["cluster", "url"]).select(
        "cluster", F.struct("categories", "title_embedding", "content_embedding").alias("central_doc"))
    return assign.choose_clusters(docs, old, heads, table)


# -- communities -------------------------------------------------------------------------------------

def create_communities(spark, sf):
    return layers.create_communities(cluster_feed(spark, sf), share_categories(category_feed(spark)), DAY)


def append_communities(spark, sf):
    feed, links = cluster_feed(spark, sf), links_state(spark, sf)
    live = tables.hydrated_communities(communities_state(spark, sf), links, feed)
    rest = feed.join(links.select("cluster_id"), "cluster_id", "left_anti")
    return assign.append_to_communities(rest, live, share_categories(category_feed(spark)))


def split_communities(spark, sf):
    return layers.split_communities(grouped(spark, sf), share_categories(category_feed(spark)), DAY)


def _rolled(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = grouped(spark, sf).withColumn("community_id", F.when(F.col("g") % 6 == 5, F.lit("x_-1")).otherwise(F.col("community_id")))
    return rows, communities.community_links(rows, DAY)


def community_rollup(spark, sf):
    rows, links = _rolled(spark, sf)
    return communities.roll_up(rows, links).select(
        "community_id", "size", "timestamp", "clusters", F.array_join("most_common_categories", "|").alias("top"))


def community_link_rows(spark, sf):
    return _rolled(spark, sf)[1]


def community_tags(spark, sf):
    rows, links = _rolled(spark, sf)
    return communities.community_tags(rows, links)


def stale_links(spark, sf):
    links = links_state(spark, sf)
    dead, drop = communities.stale_links(tables.live_links(links, DAY), tables.live_clusters(cluster_feed(spark, sf), DAY, inclusive=True))
    return dead.select(F.lit("link").alias("kind"), F.col("cluster_id").alias("id")).unionByName(
        drop.select(F.lit("community").alias("kind"), F.col("community_id").alias("id")))


# -- tables ------------------------------------------------------------------------------------------

def upsert_docs(spark, sf):
    current = history(spark, sf).select("url", "cluster_id", "timestamp", "unclusterized")
    late = doc_feed(spark, sf).where(F.col("timestamp") >= F.lit(DAY - dt.timedelta(days=1)))
    updates = late.select("url", F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("new_"), F.col("b").cast("string"))).alias("cluster_id"),
                          F.lit(DAY).alias("timestamp"), (F.col("doc_id") % 3 == 0).alias("unclusterized"))
    return store.replace_rows(current, updates, ["url"])


def category_pairs(spark, sf):
    """Ingest form of pair distances measured on the documents: share of a language in a source."""
    from .daily import sorted_pairs
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    by = docs.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("m"))
    pairs = by.select(F.when(F.col("m") % 2 == 0, F.col("source")).otherwise(F.col("lang")).alias("first_category"),
                      F.when(F.col("m") % 2 == 0, F.col("lang")).otherwise(F.col("source")).alias("second_category"),
                      (F.lit(1.0) / F.col("n")).alias("distance"))
    return sorted_pairs(pairs).withColumn("distance", six(F.col("distance")))


def upsert_clusters_partial(spark, sf):
    current = cluster_feed(spark, sf).select("cluster_id", "cluster_label", "timestamp", "size",
                                             F.col("centroid_embedding")[0].alias("head"))
    updates = cluster_feed(spark, sf).select(
        F.when(F.col("g") % 2 == 0, F.col("cluster_id")).otherwise(F.concat(F.lit("u_"), F.col("cluster_id"))).alias("cluster_id"),
        F.when(F.col("k") % 2 == 0, F.lit("renamed")).alias("cluster_label"), F.lit(DAY).alias("timestamp"),
        F.lit(None).cast("bigint").alias("size"),
        F.when(F.col("g") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("centroid_embedding")[1]).alias("head"))
    return store.merge_rows(current, updates, ["cluster_id"]).withColumn("head", six(F.col("head")))


def upsert_links(spark, sf):
    return store.replace_rows(links_state(spark, sf), _rolled(spark, sf)[1], ["cluster_id"])


def upsert_communities(spark, sf):
    rows, links = _rolled(spark, sf)
    new = communities.roll_up(rows, links).select("community_id", "size", F.lit(None).cast("date").alias("timestamp"))
    return store.merge_rows(communities_state(spark, sf).select("community_id", "size", "timestamp"), new, ["community_id"])


def delete_stale(spark, sf):
    links = links_state(spark, sf)
    dead, _ = communities.stale_links(links, cluster_feed(spark, sf))
    return store.delete_rows(links, dead, ["cluster_id"])


def _own_store(spark) -> store.Store:
    return store.Store(spark, f"{scratch_root(spark)}/topicloom/store-{uuid.uuid4().hex}")


def runs_by_day(spark, sf):
    """The assignment table after three runs over the documents: each replaces the rows of those it moves, and a day's
    dropped topics are deleted by their ids."""
    feed = doc_feed(spark, sf)
    kept = _own_store(spark)
    if kept.exists("clusterized_docs") or not is_empty(kept.read("clusterized_docs")):
        raise RuntimeError("a new store has no tables")
    kept.create("clusterized_docs")
    for i in range(3):
        moved = feed.where(F.col("doc_id") % 3 >= i)
        kept.upsert("clusterized_docs", moved.select(
            "url", F.concat(F.lit(f"run{i}_"), F.col("b").cast("string")).alias("cluster_id"),
            F.lit(DAY - dt.timedelta(days=2 - i)).alias("timestamp"), (F.col("doc_id") % 3 == 1).alias("unclusterized")))
    gone = feed.where(F.col("b") % 7 == 3).select(F.concat(F.lit("run2_"), F.col("b").cast("string")).alias("cluster_id"))
    return kept.delete("clusterized_docs", gone, ["cluster_id"]).select("url", "cluster_id", "timestamp", "unclusterized")


def delete_by_uuid(spark, sf):
    """Clusters and communities left after deletes by uuid."""
    def left(kind: str, rows: DataFrame, gone: Column) -> DataFrame:
        kept = _own_store(spark)
        ids = {"clusters": "cluster_id", "communities": "community_id"}[kind]
        kept.write(kind, kept._widened(kind, rows.withColumn("uuid", F.md5(ids))))
        return kept.delete(kind, rows.where(gone).select(F.md5(ids).alias("uuid")), ["uuid"]).select(
            F.lit(kind).alias("kind"), F.col(ids).alias("id"), "timestamp")
    clusters = cluster_feed(spark, sf)
    groups = communities_state(spark, sf)
    return left("clusters", clusters.select("cluster_id", "cluster_label", "timestamp", "g"), F.col("g") % 4 == 1).unionByName(
        left("communities", groups.select("community_id", "size", "timestamp"), F.col("size") % 2 == 0))


def delete_by_community(spark, sf):
    """Communities left after a delete by id: those of links to clusters that are gone."""
    kept = _own_store(spark)
    kept.write("communities", kept._widened("communities", communities_state(spark, sf).select("community_id", "size", "timestamp")))
    dead, _ = communities.stale_links(links_state(spark, sf), cluster_feed(spark, sf).where("g % 3 <> 0"))
    gone = links_state(spark, sf).join(dead.where("cluster_id like 'cl_%'").select("cluster_id"), "cluster_id").select("community_id")
    return kept.delete("communities", gone.where("community_id <> 'co_0'"), ["community_id"]).select("community_id", "size", "timestamp")


# -- labels ------------------------------------------------------------------------------------------

def cluster_prompt(spark, sf):
    return labels.cluster_prompts(topics(spark, sf))


def community_prompt(spark, sf):
    clusters = grouped(spark, sf)
    n = F.expr(f"(select count(*) from parquet.`{sf}/embeddings.parquet`)")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.concat(F.lit("cl_"), (F.col("doc_id") % n).cast("string")).alias("cluster_id"))
    titles = docs.join(clusters.select("cluster_id", "community_id"), "cluster_id")
    return labels.community_prompts(clusters, titles, communities.community_tags(clusters, clusters))


def tfidf_labels(spark, sf):
    return labels.title_terms(topics(spark, sf), "cluster")


# -- hierarchy ---------------------------------------------------------------------------------------

def pca_2d(spark, sf):
    rows = hierarchy.reduce_vectors(topics(spark, sf), "cluster", "content_embedding")
    return rows.select("cluster", "url", six(F.col("reduced")[0]).alias("x"), six(F.col("reduced")[1]).alias("y"))


def core_distances(spark, sf):
    found = hierarchy.core_distances(doc_points(topics(spark, sf), part="cluster"), DOC_TITLE, share_categories(category_feed(spark)), 2)
    return found.select(F.col("part").alias("cluster"), F.col("id").alias("url"), "core")


def density_hierarchy(spark, sf):
    points = doc_points(topics(spark, sf), part="cluster")
    return hierarchy.density_hierarchy(points, DOC_TITLE, share_categories(category_feed(spark))).select(
        F.col("part").alias("cluster"), F.col("id").alias("url"), "root")


def outlier_split(spark, sf):
    return hierarchy.split_outliers(topics(spark, sf), share_categories(category_feed(spark)), DAY, 40)


# -- jobs --------------------------------------------------------------------------------------------

def _stores(spark, sf):

    from .daily import ingest_categories
    docs = doc_feed(spark, sf).withColumn("date_created", F.col("timestamp").cast("timestamp")).withColumn(
        "summary_embedding", F.col("content_embedding")).select(*DOC_SCHEMA.names)
    kept = store.Store(spark, f"{scratch_root(spark)}/topicloom/job-{uuid.uuid4().hex}")
    ingest_categories(kept, category_feed(spark))
    return kept, docs


def daily_job(spark, sf):
    """Two days of the document job, the second on the state of the first."""
    from .daily import daily_clusters
    kept, docs = _stores(spark, sf)
    daily_clusters(kept, docs, DAY - dt.timedelta(days=1))
    return daily_clusters(kept, docs, DAY).documents


def community_job(spark, sf):
    """One day of documents, then its communities."""
    from .daily import daily_clusters, daily_communities
    kept, docs = _stores(spark, sf)
    daily_clusters(kept, docs, DAY)
    return daily_communities(kept, docs, DAY).links


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        daily_scan, doc_lookup, unwrap_hits, midnights, live_clusters_ttl, cluster_docs, missing_clusters, backlog_ttl,
        cluster_sizes, community_links, community_hydration, cluster_titles, merge_batch, dedupe_keep_first, corpus,
        document_rows, orphans, distances_vec, category_distance, cluster_distance, cluster_ids, parse_labels,
        parse_community_label, eps_edges_m1, edges_wide_vocabulary, own_distance_edges, neighbor_counts, dbscan_layer1, dbscan_layer2,
        split_clusters, centroids, central_docs, borders, profiles, cluster_rows, top_categories, category_shares,
        size_outliers, modal_layer, pick_best, append_communities, split_communities, community_rollup,
        community_link_rows, community_tags, stale_links, upsert_docs, category_pairs, upsert_clusters_partial, upsert_links,
        upsert_communities, delete_stale, runs_by_day, delete_by_uuid, delete_by_community, cluster_prompt, community_prompt, tfidf_labels, pca_2d, core_distances,
        density_hierarchy, outlier_split, daily_job, community_job)}
QUERIES |= {
    "doc_distance_m1": _doc_distance(DOC_TITLE), "doc_distance_m2": _doc_distance(DOC_CONTENT),
    "dbscan_min3": _dbscan_min(3), "dbscan_min5": _dbscan_min(5), "communities": create_communities,
    "assign_docs": _assign(), "assign_docs_as_run": _assign(pick="farthest", use_borders=False),
}
