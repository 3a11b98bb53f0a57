"""The daily jobs over several days of the feed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from topicloom.plans.daily import (clean_communities, daily_clusters, daily_communities, ingest_categories,
                                   prompts_for_communities)
from topicloom.settings import DOC_SCHEMA
from topicloom.sinks.store import Store
from topicloom.sources.feeds import category_feed, doc_feed

DAY = dt.date(2024, 1, 30)


@pytest.fixture(scope="module")
def days(spark, sf, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("job") / "tables"))
    docs = doc_feed(spark, sf).withColumn("date_created", F.col("timestamp").cast("timestamp")).withColumn(
        "summary_embedding", F.col("content_embedding")).select(*DOC_SCHEMA.names)
    ingest_categories(store, category_feed(spark))
    seen = []
    for back in (1, 0, 0):  # the last day twice
        day = DAY - dt.timedelta(days=back)
        daily_clusters(store, docs, day)
        daily_communities(store, docs, day)
        seen.append({r.url: r.cluster_id for r in store.read("clusterized_docs").collect()})
    return store, docs, seen


def test_documents_and_clusters_agree(days, spark):
    store, docs, seen = days
    assigned, clusters = store.read("clusterized_docs"), store.read("clusters")
    expected = docs.where(F.col("date_created") >= F.lit(DAY - dt.timedelta(days=1))).count()
    assert assigned.count() == expected == assigned.select("url").distinct().count()
    assert clusters.count() == clusters.select("cluster_id").distinct().count()
    assert clusters.join(assigned, "cluster_id", "left_anti").count() == 0
    assert assigned.join(clusters, "cluster_id", "left_anti").count() == 0
    assert assigned.where(F.col("unclusterized") != F.col("cluster_id").endswith("-1")).count() == 0
    assert clusters.where("central_doc is null or size(cluster_borders) <> 2 or uuid is null").count() == 0
    # each cluster's central document is one of its documents
    heads = clusters.select("cluster_id", F.col("central_doc.url").alias("url"))
    assert heads.join(assigned, ["cluster_id", "url"], "left_anti").count() == 0
    assert clusters.where("cluster_id not like '%-1' and cluster_label = ''").count() == 0


def test_rerun_keeps_documents(days):
    _, _, seen = days
    assert set(seen[0]) < set(seen[1]) and seen[1] == seen[2]


def test_rerun_keeps_all_tables(days):
    """The second run of a day publishes the rows of the first."""
    store, _, _ = days
    runs = [r for r in store.commits() if r["tags"] and r["tags"][0][1] == DAY.isoformat()]
    assert [r["tags"][0][0] for r in runs] == ["daily_clusters", "daily_communities"] * 2
    for first, second in zip(runs, runs[2:]):
        for table in ("clusters", "clusterized_docs") if first["tags"][0][0] == "daily_clusters" else ("cluster_communities", "communities"):
            a, b = (sorted(map(repr, store.read(table, r).collect())) for r in (first, second))
            assert a and a == b, table


def test_a_day_before_the_last_is_refused(days):
    store, docs, _ = days
    commits = len(store.commits())
    for job in (daily_clusters, daily_communities):
        with pytest.raises(ValueError):
            job(store, docs, DAY - dt.timedelta(days=1))
    assert len(store.commits()) == commits


def test_a_run_that_stops_publishes_nothing(days, monkeypatch):
    """Between its clusters and its documents, a run shows neither."""
    store, docs, _ = days
    before = store.commits()[-1]
    upsert = Store.upsert

    def stops(self, table, updates):
        if table == "clusterized_docs":
            raise RuntimeError("stopped")
        return upsert(self, table, updates)

    monkeypatch.setattr(Store, "upsert", stops)
    with pytest.raises(RuntimeError):
        daily_clusters(store, docs, DAY)
    assert store.commits()[-1] == before


def test_links_cover_live_clusters(days):
    store, docs, _ = days
    links, communities = store.read("cluster_communities"), store.read("communities")
    live = store.read("clusters").where("cluster_id not like '%-1'")
    assert live.join(links, "cluster_id", "left_anti").count() == 0
    assert links.count() == links.select("cluster_id").distinct().count()
    assert links.join(live, "cluster_id").join(communities, "community_id", "left_anti").count() == 0
    assert communities.where("size is null or timestamp is null or size(most_common_categories) = 0").count() == 0
    assert prompts_for_communities(store, docs).where("prompt not like 'LABEL: %'").count() == 0


def test_temporary_communities_are_dropped_next_day(days):
    store, _, _ = days
    temporary = store.read("cluster_communities").where("unclusterized").select("community_id")
    clean_communities(store, DAY)
    assert store.read("communities").join(temporary, "community_id", "left_semi").count() == 0


def test_empty_day_changes_nothing(days):
    store, docs, _ = days
    before = store.read("clusters").count()
    result = daily_clusters(store, docs.where("false"), DAY + dt.timedelta(days=60))
    assert result.clusters.count() == before
