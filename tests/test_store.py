"""Versioned tables: upserts, partial updates, deletes, sanitising."""

import datetime as dt
import math
from pathlib import Path

import pytest

from topicloom.plans.daily import ingest_categories
from topicloom.settings import TABLES
from topicloom.sinks.store import ConcurrentWrite, Store, sanitized

DAY = dt.date(2024, 1, 30)


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "tables"))


def test_missing_table_reads_empty(store):
    assert not store.exists("clusters") and store.read("clusters").count() == 0
    assert store.read("clusters").schema == TABLES["clusters"]
    store.create("clusters")
    assert store.exists("clusters")


def rows(spark, *data):
    return spark.createDataFrame(list(data), TABLES["clusterized_docs"])


def test_documents_are_replaced(spark, store):
    store.upsert("clusterized_docs", rows(spark, ("a", "c1", DAY, False), ("b", "c1", DAY, False)))
    update = rows(spark, ("b", None, DAY + dt.timedelta(days=1), True), ("c", "c2", DAY, False))
    for _ in range(2):  # a repeated update changes nothing
        store.upsert("clusterized_docs", update)
        got = {r.url: (r.cluster_id, r.timestamp.day, r.unclusterized) for r in store.read("clusterized_docs").collect()}
        assert got == {"a": ("c1", 30, False), "b": (None, 31, True), "c": ("c2", 30, False)}
    plan = store.read("clusterized_docs").where("timestamp > date'2024-01-30'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(timestamp" in plan
    store.create("clusterized_docs", reset=True)
    assert store.read("clusterized_docs").count() == 0


def cluster(cid, label, centroid, day=DAY, categories=None):
    return ("u" + cid, cid, label, day, centroid, None, None, ["t"], categories, None)


def test_clusters_are_partially_updated(spark, store):
    make = lambda *r: spark.createDataFrame(list(r), TABLES["clusters"])
    store.upsert("clusters", make(cluster("1", "one", [1.0]), cluster("2", "two", [2.0], categories=[("a", 3)])))
    store.upsert("clusters", make(cluster("2", None, [math.nan, 5.0], None), cluster("3", "three", None)))
    got = {r.cluster_id: (r.cluster_label, r.centroid_embedding, r.timestamp) for r in store.read("clusters").collect()}
    assert got == {"1": ("one", [1.0], DAY), "2": ("two", [5.0], DAY), "3": ("three", None, DAY)}
    assert [tuple(c) for c in store.read("clusters").where("cluster_id = '2'").first().categories] == [("a", 3)]


def test_delete_and_versions(spark, store):
    store.upsert("clusterized_docs", rows(spark, ("a", "c1", DAY, False), ("b", "c2", DAY, False)))
    store.delete("clusterized_docs", spark.createDataFrame([("c1",), ("zz",)], "cluster_id string"), ["cluster_id"])
    assert [r.url for r in store.read("clusterized_docs").collect()] == ["b"]
    assert store.vacuum(keep=1) == 1 and len(store.commits()) == 1 and store.read("clusterized_docs").count() == 1
    assert store.vacuum(keep=1) == 0


def folders(store, table):
    return {day: folder for day, folder in store.commits()[-1]["tables"][table]}


def test_days_that_do_not_change_stay_in_place(spark, store):
    """Only the days of changed keys, before and after, are written again; a key may move from one day to another."""
    days = [DAY - dt.timedelta(days=i) for i in range(5)]
    store.upsert("clusterized_docs", rows(spark, *[(f"u{i}", "c", d, False) for i, d in enumerate(days)], ("u9", "c", days[0], False)))
    before = folders(store, "clusterized_docs")
    assert set(before) == {d.isoformat() for d in days}
    store.upsert("clusterized_docs", rows(spark, ("u1", "moved", days[3], False), ("new", "c", days[4], False)))
    after = folders(store, "clusterized_docs")
    assert {d for d in after if after[d] == before[d]} == {days[0].isoformat(), days[2].isoformat()} and days[1].isoformat() not in after
    got = {r.url: (r.cluster_id, r.timestamp) for r in store.read("clusterized_docs").collect()}
    assert got == {"u0": ("c", days[0]), "u1": ("moved", days[3]), "u2": ("c", days[2]), "u3": ("c", days[3]), "u4": ("c", days[4]),
                   "u9": ("c", days[0]), "new": ("c", days[4])}
    store.delete("clusterized_docs", spark.createDataFrame([("u2",), ("absent",)], "url string"))
    last = folders(store, "clusterized_docs")
    assert days[2].isoformat() not in last and all(last[d] == after[d] for d in last)
    # a partial update without a day keeps the row in its own
    make = lambda *r: spark.createDataFrame(list(r), TABLES["clusters"])
    store.upsert("clusters", make(cluster("1", "one", [1.0]), cluster("2", "two", [2.0], day=None)))
    assert set(folders(store, "clusters")) == {DAY.isoformat(), ""}
    store.upsert("clusters", make(cluster("1", "uno", None, day=None), cluster("2", None, None, day=days[1])))
    assert {r.cluster_id: (r.cluster_label, r.timestamp) for r in store.read("clusters").collect()} == {"1": ("uno", DAY), "2": ("two", days[1])}


def test_a_stopped_transaction_changes_nothing(spark, store):
    store.upsert("clusterized_docs", rows(spark, ("a", "c1", DAY, False)))
    make = lambda *r: spark.createDataFrame(list(r), TABLES["clusters"])
    with pytest.raises(KeyError):
        with store.transaction():
            store.upsert("clusters", make(cluster("1", "one", [1.0])))
            store.upsert("clusterized_docs", rows(spark, ("a", "1", DAY, False)))
            assert store.read("clusters").count() == 1 and store.read("clusterized_docs").first().cluster_id == "1"
            raise KeyError("stopped between two tables")
    assert not store.exists("clusters") and store.read("clusterized_docs").first().cluster_id == "c1" and len(store.commits()) == 1
    with store.transaction():
        store.upsert("clusters", make(cluster("1", "one", [1.0])))
        store.upsert("clusterized_docs", rows(spark, ("a", "1", DAY, False)))
    assert len(store.commits()) == 2 and store.read("clusters").count() == 1


def test_two_writers_do_not_overwrite_each_other(spark, store):
    other = Store(spark, store.root)
    store.upsert("clusterized_docs", rows(spark, ("a", "c1", DAY, False)))
    with pytest.raises(ConcurrentWrite):
        with store.transaction():
            store.upsert("clusterized_docs", rows(spark, ("a", "mine", DAY, False)))
            other.upsert("clusterized_docs", rows(spark, ("b", "theirs", DAY, False)))
    assert {r.url: r.cluster_id for r in store.read("clusterized_docs").collect()} == {"a": "c1", "b": "theirs"}
    # a number that is claimed in the same moment
    with pytest.raises(ConcurrentWrite):
        with store.transaction():
            (Path(store.root) / "_commits" / "000000000003.json").write_text("")
    assert store.read("clusterized_docs").count() == 2
    store.upsert("clusterized_docs", rows(spark, ("c", "c1", DAY, False)))
    assert [r["number"] for r in store.commits()] == [1, 2, 4] and store.read("clusterized_docs").count() == 3


def test_state_before_a_day(spark, store):
    days = [DAY + dt.timedelta(days=i) for i in range(3)]
    for i, d in enumerate(days[:2]):
        for _ in range(2):
            with store.transaction(("job", d), base=store.before("job", d)):
                had = store.read("clusterized_docs").count() if i else 0
                store.upsert("clusterized_docs", rows(spark, (f"u{i}", "c", d, False)))
                assert had == i
    assert store.before("job", days[2]) is None and store.before("another", days[0]) is None
    assert store.read("clusterized_docs", store.before("job", days[1])).count() == 1
    assert store.read("clusterized_docs", store.before("job", days[0])).count() == 0
    assert store.later("job", days[0]) == [days[1].isoformat()] and store.later("job", days[1]) == []


def test_folders_without_a_commit_are_ignored(spark, store, tmp_path):
    store.upsert("clusterized_docs", rows(spark, ("a", "c1", DAY, False)))
    left = tmp_path / "tables" / "clusterized_docs" / "w=left" / f"timestamp={DAY}"
    left.mkdir(parents=True)
    (tmp_path / "tables" / "_commits" / "000000000002.json").write_text('{"number": 2, "tab')
    assert store.read("clusterized_docs").count() == 1
    store.upsert("clusterized_docs", rows(spark, ("b", "c1", DAY, False)))
    assert store.read("clusterized_docs").count() == 2
    assert store.vacuum(keep=1) == 2 and not left.exists() and store.read("clusterized_docs").count() == 2


def test_two_updates_of_one_key_are_refused(spark, store):
    with pytest.raises(ValueError):
        store.upsert("clusterized_docs", rows(spark, ("a", "c1", DAY, False), ("a", "c2", DAY, False)))


def test_sanitising_reaches_nested_fields(spark):
    df = spark.createDataFrame([(math.nan, [1.0, math.nan, None], (math.nan, "x"))], "a double, b array<double>, c struct<d:double,e:string>")
    r = sanitized(df).first()
    assert r.a is None and r.b == [1.0] and r.c.d is None and r.c.e == "x"


def test_category_ingest_sorts_pairs(spark, store):
    pairs = spark.createDataFrame([("b", "a", 0.5), ("a", "c", 0.2)], "first_category string, second_category string, distance double")
    for _ in range(2):
        got = {(r.first_category, r.second_category): r.distance for r in ingest_categories(store, pairs).collect()}
        assert got == {("a", "b"): 0.5, ("a", "c"): 0.2}
