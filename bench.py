"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from topicloom.plans.queries import QUERIES

HEADLINE = [
    "eps_edges_m1", "neighbor_counts", "dbscan_layer1", "dbscan_layer2", "dbscan_min3", "split_clusters", "profiles",
    "assign_docs", "pick_best", "communities", "append_communities", "split_communities", "community_rollup",
    "density_hierarchy", "outlier_split", "cluster_prompt", "tfidf_labels", "merge_batch", "upsert_docs", "daily_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("topicloom-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("sum(n_chars)").collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
