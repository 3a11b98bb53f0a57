"""Scalar functions and small aggregates on hand-made rows."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from topicloom.functions import vectors
from topicloom.functions.categories import known, leading_shares, with_category_distance, with_shared_category_term
from topicloom.functions.ids import (first_value, id_day, id_label, is_noise, midnight, noise_id, reference_date, split_id,
                                     topic_id)
from topicloom.functions.responses import community_label, response_label, response_tags
from topicloom.operators.batch import document_rows, keep_first, merge_batch, with_age
from topicloom.operators.labels import cluster_prompts, community_prompts
from topicloom.operators.layers import split_clusters, split_communities
from topicloom.operators.lookup import share_categories
from topicloom.operators.profile import central_documents, centroids, modal_flag, oversized, profiles
from topicloom.sources.tables import daily_documents, live_clusters, read_table, require_complete, require_unique
from topicloom.settings import TABLES

DAY = dt.date(2024, 1, 30)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_vectors(spark):
    x, y = F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(4.0), F.lit(6.0))
    assert one(spark, vectors.euclidean(x, y)) == 5.0 and one(spark, vectors.manhattan(x, y)) == 7.0
    similarity = one(spark, vectors.cosine_similarity(x, y))
    assert abs(similarity - 16 / (5 ** 0.5 * 52 ** 0.5)) < 1e-12
    assert abs(one(spark, vectors.cosine_distance(x, y)) - (1 - similarity)) < 1e-12


def test_ids(spark):
    topic = one(spark, topic_id(F.lit(3), F.lit(DAY)))
    assert topic == "2024-01-30_" + hashlib.sha256(b"2024-01-30_3").hexdigest() + "_3"
    assert one(spark, id_day(F.lit(topic))) == "2024-01-30" and one(spark, id_label(F.lit(topic))) == "3"
    assert one(spark, is_noise(noise_id(F.lit(DAY)))) and not one(spark, is_noise(F.lit(topic)))
    part = one(spark, split_id(F.lit(topic), F.lit(1), F.lit(DAY)))
    assert part.endswith("_3.1") and hashlib.sha256(f"2024-01-30_{topic}_1".encode()).hexdigest() in part


@pytest.mark.parametrize("text, expected", [
    ("2024-01-30T10:11:12.345Z", dt.datetime(2024, 1, 30)), ("2024-01-30T10:11:12.345678Z", dt.datetime(2024, 1, 30)),
    ("2024-01-30T10:11:12.3Z", dt.datetime(2024, 1, 30)), ("yesterday", None)])
def test_midnight(spark, text, expected):
    assert one(spark, midnight(F.lit(text))) == expected


def test_reference_date():
    assert reference_date("2024-01-30") == reference_date(DAY) == reference_date(dt.datetime(2024, 1, 30, 9)) == DAY
    for wrong in ("30.01.2024", 5, None):
        with pytest.raises(TypeError):
            reference_date(wrong)


def test_first_value(spark):
    rows = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "v array<string>")
    assert [r[0] for r in rows.select(first_value(F.col("v"))).collect()] == ["a", None, None]


@pytest.mark.parametrize("text, label, tags", [
    ("cluster label: A b\ncluster tags: x, y", "A b", ["x", "y"]),
    ('Cluster label: "A"\nCluster tags: [x , y]', "A", ["x", "y"]),
    ("- A\n- x,y", "A", ["x", "y"]),
    ('"-A"\n-"[x]"', "A", ["x"]), ("only", "only", []), ("", "", []), ('"\ntag', "", ["tag"])])
def test_responses(spark, text, label, tags):
    assert one(spark, response_label(F.lit(text))) == label
    assert one(spark, response_tags(F.lit(text))) == tags


@pytest.mark.parametrize("text, label", [("COMMUNITY: X", "X"), ('Community: -"X y"', "X y"), ("- X", "X"), ("X", "X")])
def test_community_label(spark, text, label):
    assert one(spark, community_label(F.lit(text))) == label


def pairs_table(spark):
    return spark.createDataFrame([("a", "b", 0.4), ("a", "a", 0.0), ("b", "b", 3.0)],
                                 "first_category string, second_category string, distance double")


@pytest.mark.parametrize("x, y, expected", [
    (["a"], ["b"], 0.4), (["b"], ["a"], 0.4), (["a"], ["zz"], 1.0), (["a", "b"], ["a"], 0.2), ([], ["a"], 1.0),
    (["unknown"], ["a"], 1.0), (["unknown", "a"], ["a"], 0.0), (None, ["a"], 1.0), (["b"], ["b"], 1.0)])
def test_category_distance(spark, x, y, expected):
    df = spark.createDataFrame([(x, y)], "x array<string>, y array<string>")
    assert abs(with_category_distance(df, "x", "y", pairs_table(spark)).first()["category_distance"] - expected) < 1e-12


def test_leading_category_and_shared_term(spark):
    rows = spark.createDataFrame([([("b", 2), ("a", 2), ("c", 1)], [("b", 3)])],
                                 "x array<struct<category:string,n:bigint>>, y array<struct<category:string,n:bigint>>")
    top = rows.select(leading_shares(F.col("x")).alias("x"), leading_shares(F.col("y")).alias("y"))
    assert [tuple(e) for e in top.first()["x"]] == [("a", 0.4)]
    term = lambda shares: with_shared_category_term(top, "x", "y", pairs_table(spark), shares).first()["category_term"]
    assert abs(term(True) - 0.4 * 0.4) < 1e-12 and abs(term(False) - 0.4) < 1e-12


def test_known(spark):
    assert one(spark, known(F.lit(None).cast("array<string>"))) == []


def test_ttl_boundary(spark):
    rows = spark.createDataFrame([("a", dt.date(2023, 12, 31)), ("b", dt.date(2024, 1, 1))], "cluster_id string, timestamp date")
    assert [r[0] for r in live_clusters(rows, DAY).collect()] == ["b"]
    assert {r[0] for r in live_clusters(rows, DAY, inclusive=True).collect()} == {"a", "b"}


def test_missing_table_is_empty(spark):
    df = read_table(spark, "no_such_table", TABLES["clusters"])
    assert df.count() == 0 and df.schema == TABLES["clusters"]


def test_guards(spark):
    a = spark.createDataFrame([("x",), ("y",)], "url string")
    require_complete(a, a, "url", "docs")
    require_unique(a, "url", "docs")
    with pytest.raises(ValueError):
        require_complete(a, a.where("url = 'x'"), "url", "docs")
    with pytest.raises(ValueError):
        require_unique(a.union(a), "url", "docs")


def test_daily_filter_is_pushed_down(spark, sf):
    docs = spark.read.parquet(f"{sf}/orders.parquet")
    plan = daily_documents(docs.select("o_orderkey", "o_orderdate"), dt.date(1995, 1, 1), "o_orderdate")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_batch_keeps_new_document(spark):
    new = spark.createDataFrame([("u", "new", ["a"]), ("v", "new", None)], "url string, title string, categories array<string>")
    old = spark.createDataFrame([("u", "old", ["a"]), ("w", "old", [])], "url string, title string, categories array<string>")
    assert {(r.url, r.title) for r in merge_batch(new, old).collect()} == {("u", "new"), ("w", "old")}


def test_document_rows(spark):
    rows = spark.createDataFrame([("u", "c_1", DAY), ("v", "c_-1", None), ("w", None, DAY)], "url string, cluster string, timestamp date")
    got = {r.url: (r.cluster_id, r.timestamp, r.unclusterized) for r in document_rows(rows, DAY).collect()}
    assert got == {"u": ("c_1", DAY, False), "v": ("c_-1", DAY, True), "w": (None, DAY, True)}
    assert not with_age(rows.where("url = 'u'"), DAY).first()["old_doc"]


def test_keep_first(spark):
    rows = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("m", 5, "c")], "key string, rank int, v string")
    assert {tuple(r) for r in keep_first(rows, "key", "rank").collect()} == {("k", 1, "a"), ("m", 5, "c")}


def docs(spark, rows):
    return spark.createDataFrame([(u, u, c, t, v, v, DAY) for u, c, t, v in rows],
                                 "url string, title string, cluster string, categories array<string>, "
                                 "title_embedding array<double>, content_embedding array<double>, timestamp date")


def test_central_document_comes_from_its_own_cluster(spark):
    rows = docs(spark, [("a", "1", ["a"], [0.0, 0.0]), ("b", "1", ["a"], [2.0, 0.0]), ("z", "2", ["a"], [1.0, 0.0])])
    got = {r.cluster: r.url for r in central_documents(rows, centroids(rows, "cluster", "content_embedding")).collect()}
    assert got == {"1": "a", "2": "z"}  # a and b tie, the smaller url wins


def test_profile_includes_the_central_document(spark):
    rows = docs(spark, [("a", "x_1", ["a"], [0.0]), ("b", "x_1", ["a"], [0.2]), ("c", "x_1", ["b"], [0.1])])
    r = profiles(rows, pairs_table(spark)).first()
    low, high = r.cluster_borders
    assert (r.central_doc.url, r.label, r["size"]) == ("c", "1", 3)
    # the central document is 0.1 from itself: its own category pair is at distance 1
    assert low["max"].url == "a" and abs(low["max"].distance - (0.09 + 0.04)) < 1e-9 and low["min"].url == "c"
    assert abs(high.avg - (2 * (0.08 + 0.08) + 0.2) / 3) < 1e-9


def test_size_outliers(spark):
    sizes = spark.createDataFrame([(f"c_{i}", 2) for i in range(30)] + [("c_big", 40), ("c_-1", 500)], "cluster_id string, size bigint")
    assert [r.cluster_id for r in oversized(sizes).collect()] == ["c_big"]
    few = spark.createDataFrame([(f"c_{i}", 1) for i in range(30)] + [("c_big", 9)], "cluster_id string, size bigint")
    assert oversized(few).count() == 0 and oversized(few, minimum=0).count() == 1


def test_modal_flag_tie_is_false(spark):
    rows = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("b", True), ("b", False)], "k string, f boolean")
    assert {r.k: r.f for r in rows.groupBy("k").agg(modal_flag(F.col("f")).alias("f")).collect()} == {"a": False, "b": True}


def test_split_leaves_whole_clusters_alone(spark):
    table = share_categories(pairs_table(spark))
    near, far = [0.0, 0.0], [5.0, 5.0]
    rows = docs(spark, [("a", "d_1", ["a"], near), ("b", "d_1", ["a"], near), ("c", "d_2", ["a"], near), ("d", "d_2", ["a"], near),
                        ("e", "d_2", ["a"], far), ("f", "d_2", ["a"], far), ("g", "d_2", ["a"], [50.0, 0.0]),
                        ("h", "d_3", ["a"], near), ("i", "d_3", ["a"], far), ("j", "d_-1", ["a"], far)])
    flags = rows.withColumn("first_layer", F.col("cluster") != "d_3").withColumn("second_layer", F.lit(False))
    got = {r.url: r.new for r in split_clusters(flags, table, DAY).collect()}
    assert set(got) == set("cdefg") and got["c"] == got["d"] != got["e"] == got["f"]
    assert got["c"].endswith("_2.0") and got["e"].endswith("_2.1") and got["g"].endswith("_-1")


def test_split_of_a_large_community(spark):
    table = share_categories(pairs_table(spark))
    rows = [(f"k{i}", f"co_{i}", [float(i), 9.0], 2) for i in range(12)]
    rows += [("m1", "co_big", [0.0, 0.0], 30), ("m2", "co_big", [0.01, 0.0], 30), ("m3", "co_big", [0.0, 3.0], 30)]
    df = spark.createDataFrame([(a, b, v, s, [("a", 1)]) for a, b, v, s in rows],
                               "cluster_id string, community_id string, centroid_embedding array<double>, size bigint, "
                               "categories array<struct<category:string,n:bigint>>")
    got = {r.cluster_id: r.new for r in split_communities(df, table, DAY).collect()}
    assert set(got) == {"m1", "m2", "m3"} and got["m1"] == got["m2"] and got["m3"].endswith("_-1") and got["m1"].endswith("_big.0")


def greedy(lines, budget=4097):
    text = ""
    for line in lines:
        if len(text) + len(line) > budget:
            break
        text += line
    return text


def test_prompts_stop_at_the_first_line_that_does_not_fit(spark):
    titles = [f"t{i:04d} " + "x" * (17 * (i % 9)) for i in range(700)]
    rows = spark.createDataFrame([(f"u{i:04d}", "c_1", t) for i, t in enumerate(titles)] + [("v", "c_-1", "noise"), ("w", "c_2", "y" * 5000), ("w2", "c_2", "z")],
                                 "url string, cluster string, title string").repartition(6)
    got = {r.cluster: r.prompt for r in cluster_prompts(rows).collect()}
    assert got == {"c_1": greedy(f"TITLE: {t}\n" for t in titles), "c_2": ""}
    empty = spark.createDataFrame([(f"u{i:04d}", "c_1", "") for i in range(2000)], "url string, cluster string, title string")
    assert cluster_prompts(empty).first()["prompt"] == greedy(["TITLE: \n"] * 2000)


def test_community_prompt_sections(spark):
    labels = spark.createDataFrame([("k", f"c{i:02d}", f"label {i}") for i in range(35)], "community_id string, cluster_id string, cluster_label string")
    titles = spark.createDataFrame([("k", f"u{i:02d}", "t" * (90 + i)) for i in range(40)], "community_id string, url string, title string")
    tags = spark.createDataFrame([("k", f"tag{i % 300:03d}") for i in range(600)], "community_id string, tag string")
    text = greedy(f"LABEL: label {i}\n" for i in range(30))
    for i in range(30):
        line = "TITLE: " + "t" * (90 + i) + "\n"
        if len(text) + len(line) > 4097:
            break
        text += line
    for i in range(300):
        line = f"TAG: tag{i:03d}\n"
        if len(text) + len(line) > 4097:
            break
        text += line
    assert community_prompts(labels, titles, tags).first()["prompt"] == text


def test_few_anchors_gather_no_rows(spark, sf):
    """Neither the anchors of the feed nor the lead of a bucket shuffle the documents by a handful of keys."""
    from topicloom.plans.queries import lead_pairs

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = str(lead_pairs(spark, sf)._jdf.queryExecution().sparkPlan())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # the feed is read twice, and each time its documents meet their own vector in a shuffle
    assert plan.count("SortMergeJoin") == 2 and plan.count("BroadcastHashJoin") == 5
