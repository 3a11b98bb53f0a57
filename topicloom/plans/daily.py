"""The daily jobs: documents to clusters, clusters to communities, category distances."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import is_noise, reference_date
from ..operators.assign import append_to_communities, assign_documents, choose_clusters
from ..operators.batch import (cluster_rows, corpus, document_rows, merge_batch, orphans, with_age,
                               with_layer_flags)
from ..operators.communities import community_links, community_tags, roll_up, stale_links
from ..operators.hierarchy import split_outliers
from ..operators.labels import (community_labels_from_responses, community_prompts, labels_from_responses,
                                labels_from_titles)
from ..operators.layers import create_communities, first_layer, second_layer, split_clusters, split_communities
from ..operators.lookup import share_categories
from ..operators.profile import category_profile, central_documents, centroids, profiles
from ..session import cut, is_empty, prepare, scratch_scope
from ..settings import TTL_DAYS
from ..sinks.store import Store
from ..sources.tables import (backlog, cluster_documents, cluster_titles, daily_documents, hydrated_communities,
                              live_clusters, live_links, require_complete, require_unique, with_sizes)

BODY = ["url", "title", "categories", "timestamp", "title_embedding", "content_embedding"]


@dataclass
class DailyResult:
    """What one run published."""

    documents: DataFrame
    clusters: DataFrame


def sorted_pairs(pairs: DataFrame) -> DataFrame:
    """``(first_category, second_category, distance)`` with each pair once, in sorted order and with
    its smallest distance."""
    low, high = F.least("first_category", "second_category"), F.greatest("first_category", "second_category")
    return (pairs.groupBy(low.alias("first_category"), high.alias("second_category"))
            .agg(F.min("distance").alias("distance")))


def ingest_categories(store: Store, pairs: DataFrame, reset: bool = False) -> DataFrame:
    """Load category distances; the id of a pair follows from its names."""
    store.create("categories_distances", reset)
    return store.upsert("categories_distances", sorted_pairs(pairs).withColumn(
        "id", F.xxhash64("first_category", "second_category")))


def _moved(rows: DataFrame, moves: DataFrame) -> DataFrame:
    """Apply ``(url, old, new)`` moves to the ``cluster`` column."""
    return (rows.join(moves.select("url", "new"), "url", "left")
            .withColumn("cluster", F.coalesce("new", "cluster")).drop("new"))


def _published(*owned: str):
    """Run a job for a day on the state before that day and publish its tables as one commit.

    A repeated run of a day starts from what the first one found in the ``owned`` tables, so it replaces that day's
    result. A day is refused once the job has run for a later one, whose result rests on it. The job's scratch
    tables are dropped when it ends.
    """
    def decorate(job):
        @wraps(job)
        def run(store: Store, docs: DataFrame, ref_date: dt.date | str, **kwargs):
            day = reference_date(ref_date)
            if later := store.later(job.__name__, day):
                raise ValueError(f"{job.__name__} has run for {later[0]}, which is after {day}")
            first = store.before(job.__name__, day)
            base = first and {"tables": {t: first["tables"].get(t, []) for t in owned}}
            with scratch_scope(prepare(store.spark)), store.transaction((job.__name__, day), base=base):
                return job(store, docs, day, **kwargs)
        return run
    return decorate


@_published("clusters", "clusterized_docs")
def daily_clusters(store: Store, docs: DataFrame, ref_date: dt.date | str, *, responses: DataFrame | None = None,
                   pick: str = "nearest", use_borders: bool = True, **sizes) -> DailyResult:
    """Cluster the documents of ``ref_date`` and the backlog, and publish the changed tables.

    ``docs`` has the columns of ``settings.DOC_SCHEMA``. ``responses(cluster_id, response)`` supplies
    label texts; without it labels come from title terms.
    """
    day = reference_date(ref_date)
    table = store.read("categories_distances")
    shared = share_categories(table)
    # A cluster is as old as its oldest document, so documents of live clusters and of the backlog
    # lie inside the time to live: older files of both tables are skipped.
    oldest = F.lit(day - dt.timedelta(days=TTL_DAYS))
    assigned = store.read("clusterized_docs").where(F.col("timestamp") > oldest)
    bodies = docs.where(F.col("date_created") > oldest).withColumn("timestamp", F.to_date("date_created")).select(*BODY)

    # live clusters with their documents; profiles follow from the documents
    live = live_clusters(store.read("clusters"), day).where(~is_noise(F.col("cluster_id")))
    owned = cluster_documents(assigned, live).select("url", F.col("cluster_id").alias("cluster"))
    require_complete(owned, bodies, "url", "documents of live clusters")
    require_unique(assigned, "url", "clusterized documents")
    owned = cut(bodies.join(owned, "url"), "live-docs")
    old_profiles = cut(profiles(owned, table), "live-profiles")

    new_docs = daily_documents(docs, day).withColumn("timestamp", F.to_date("date_created")).select(*BODY)
    matches = assign_documents(new_docs, old_profiles.withColumnRenamed("cluster", "cluster_id"), shared,
                               pick=pick, use_borders=use_borders, **sizes.pop("assign", {}))
    matches = cut(matches, "matches")
    left_over = backlog(assigned, bodies, day).withColumnRenamed("cluster_id", "cluster")
    batch = cut(with_age(merge_batch(new_docs, left_over), day), "batch")
    if is_empty(batch):
        return DailyResult(store.read("clusterized_docs"), store.read("clusters"))

    # first layer, its oversized clusters, second layer, its oversized clusters
    body = batch.drop("cluster")
    n = old_profiles.count()
    layer1 = cut(body.join(first_layer(body, shared, day, **sizes), "url"), "layer1")
    n += layer1.select("cluster").distinct().count()
    layer1 = _moved(layer1, split_outliers(layer1, shared, day, n, **sizes))
    layer1 = cut(layer1.withColumn("entered", is_noise(F.col("cluster"))), "layer1-split")
    n += layer1.select("cluster").distinct().count()
    layer2 = cut(layer1.drop("cluster").join(second_layer(layer1, shared, day, n, **sizes), "url"), "layer2")
    n += layer2.select("cluster").distinct().count()
    # documents that entered the second layer are looked at again, also those that a split of the first threw out
    reopened = layer2.where("entered")
    docs_now = cut(_moved(layer2, split_outliers(reopened, shared, day, n, **sizes)).drop("entered"), "layer2-split")

    # old or new cluster
    means = centroids(docs_now, "cluster", "content_embedding")
    heads = central_documents(docs_now, means)
    centrals = docs_now.join(heads.select("cluster", "url"), ["cluster", "url"]).select(
        "cluster", F.struct("url", "title", "categories", "title_embedding", "content_embedding").alias("central_doc"))
    chosen = choose_clusters(docs_now, matches, centrals, table)
    docs_now = cut(docs_now.drop("cluster").join(chosen.select("url", "cluster"), "url"), "chosen")

    # corpus, splits inside clusters, final profiles
    whole = cut(with_layer_flags(corpus(docs_now, owned)), "corpus")
    whole = cut(_moved(whole, split_clusters(whole, shared, day, **sizes)), "split")
    final = cut(profiles(whole, table), "profiles")

    if responses is not None:
        labels = labels_from_responses(responses).withColumnRenamed("cluster_id", "cluster")
    else:
        labels = labels_from_titles(whole, "cluster")
    store.upsert("clusters", cut(cluster_rows(final, category_profile(whole), labels), "cluster-rows"))
    documents = store.upsert("clusterized_docs", document_rows(whole, day))
    clusters = store.read("clusters")
    clusters = store.delete("clusters", cut(orphans(clusters, documents).select("uuid"), "orphans"), ["uuid"])
    return DailyResult(documents, clusters)


@dataclass
class CommunityResult:
    links: DataFrame
    communities: DataFrame


def clean_communities(store: Store, day: dt.date) -> None:
    """Drop links to clusters that are gone, their communities, and temporary communities."""
    links = live_links(store.read("cluster_communities"), day)
    live = live_clusters(store.read("clusters"), day, inclusive=True)
    if is_empty(links) or is_empty(live):
        return
    dead, drop = stale_links(links, live)
    dead, drop = cut(dead, "dead-links"), cut(drop, "dead-communities")
    store.delete("cluster_communities", dead, ["cluster_id"])
    store.delete("communities", drop, ["community_id"])


@_published("cluster_communities", "communities")
def daily_communities(store: Store, docs: DataFrame, ref_date: dt.date | str, *,
                      responses: DataFrame | None = None, **sizes) -> CommunityResult:
    """Group live clusters into communities and publish links and communities.

    ``responses(community_id, response)`` supplies label texts; without it a community is labelled
    by the title terms of its documents.
    """
    day = reference_date(ref_date)
    clean_communities(store, day)
    table = store.read("categories_distances")
    shared = share_categories(table)
    # documents of live clusters lie inside the time to live
    assigned = store.read("clusterized_docs").where(F.col("timestamp") >= F.lit(day - dt.timedelta(days=TTL_DAYS)))
    all_clusters = store.read("clusters")
    links = live_links(store.read("cluster_communities"), day).where(~F.col("unclusterized"))

    candidates = with_sizes(live_clusters(all_clusters, day, inclusive=True), assigned)
    candidates = cut(candidates.join(links.select("cluster_id"), "cluster_id", "left_anti"), "candidates")
    if is_empty(candidates):
        return CommunityResult(store.read("cluster_communities"), store.read("communities"))

    current = store.read("communities").join(links.select("community_id").distinct(), "community_id", "left_semi")
    existing = cut(hydrated_communities(current, store.read("cluster_communities"), all_clusters), "live-communities")
    appended = cut(append_to_communities(candidates, existing, shared), "appended")
    fresh = candidates.join(appended.select("cluster_id"), "cluster_id", "left_anti")
    placed = create_communities(fresh, shared, day, **sizes).unionByName(appended.select("cluster_id", "community_id"))
    placed = cut(candidates.join(placed, "cluster_id"), "placed")
    moves = split_communities(placed, shared, day, **sizes)
    placed = cut(placed.join(moves.select("cluster_id", "new"), "cluster_id", "left")
                 .withColumn("community_id", F.coalesce("new", "community_id")).drop("new"), "communities")

    rows = cut(community_links(placed, day), "link-rows")
    communities = roll_up(placed, rows)
    # the clusters are live, hence their documents recent
    recent = docs.where(F.col("date_created") >= F.lit(day - dt.timedelta(days=TTL_DAYS)))
    titles = (cluster_titles(assigned, recent, placed).join(rows.select("cluster_id", "community_id"), "cluster_id"))
    single = (rows.where("unclusterized").join(placed.select("cluster_id", "cluster_label", "tags"), "cluster_id")
              .select("community_id", F.col("cluster_label").alias("__own"), "tags"))
    if responses is not None:
        labels = community_labels_from_responses(responses)
    else:
        labels = labels_from_titles(titles, "community_id", "community_label").drop("tags")
    digest = F.md5("community_id")
    uuid = F.concat_ws("-", *[F.substring(digest, s, n) for s, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    communities = (communities.join(labels, "community_id", "left").join(single, "community_id", "left")
                   .withColumn("community_label", F.coalesce("__own", "community_label")).withColumn("uuid", uuid))
    links_now = store.upsert("cluster_communities", rows)
    return CommunityResult(links_now, store.upsert("communities", communities.drop("clusters", "__own")))


def prompts_for_communities(store: Store, docs: DataFrame) -> DataFrame:
    """``(community_id, prompt)`` of all communities of several clusters, for a labelling service."""
    links = store.read("cluster_communities").where(~F.col("unclusterized"))
    clusters = store.read("clusters")
    labels = links.join(clusters.select("cluster_id", "cluster_label"), "cluster_id")
    titles = cluster_titles(store.read("clusterized_docs"), docs, links).join(links.select("cluster_id", "community_id"), "cluster_id")
    return community_prompts(labels, titles, community_tags(clusters, links))
