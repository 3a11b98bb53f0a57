"""Aggregates per topic: centroid, central document, borders, sizes, categories, titles."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.categories import category_counts, counted_lists, with_category_distance
from ..functions.ids import id_label, is_noise
from ..functions.metrics import comparable, weighted
from ..functions.vectors import euclidean
from ..settings import DOC_CONTENT, DOC_TITLE, OUTLIER_ALPHA, OUTLIER_MIN_DOCS

BODY = ["url", "title", "categories", "title_embedding", "content_embedding"]


def centroids(rows: DataFrame, key: str, vector: str, name: str = "centroid_embedding") -> DataFrame:
    """Element-wise mean per key; one vector per key leaves each map task."""
    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    return rows.groupBy(key).agg(vector_to_array(mean).alias(name))


def central_documents(docs: DataFrame, means: DataFrame, key: str = "cluster",
                      vector: str = "content_embedding") -> DataFrame:
    """``(key, url, distance)`` of the member closest to the centroid, smallest url on ties."""
    gap = comparable(euclidean(F.col(vector), F.col("centroid_embedding")))
    measured = docs.select(key, "url", vector).join(means, key).select(key, "url", gap.alias("distance"))
    best = F.min(F.struct("distance", "url")).alias("b")
    return measured.groupBy(key).agg(best).select(key, F.col("b.url").alias("url"), F.col("b.distance").alias("distance"))


def with_central_distances(docs: DataFrame, central: DataFrame, table: DataFrame, key: str = "cluster",
                           vector: str = "content_embedding") -> DataFrame:
    """``(key, url, d0, d1)``: distances of each member to the central document of its topic under
    the title metric (0) and the content metric (1)."""
    body = docs.select(key, "url", "categories", "title_embedding", F.col(vector).alias("__co"))
    heads = body.join(central.select(key, "url"), [key, "url"]).select(
        key, F.col("categories").alias("__hcats"), F.col("title_embedding").alias("__ht"), F.col("__co").alias("__hc"))
    pairs = body.join(heads, key).select(
        key, "url", "categories", "__hcats",
        euclidean(F.col("title_embedding"), F.col("__ht")).alias("__dt"),
        euclidean(F.col("__co"), F.col("__hc")).alias("__dc"))
    terms = with_category_distance(pairs, "categories", "__hcats", table, "__cat")
    parts = {"title_vec": F.col("__dt"), "content_vec": F.col("__dc")}
    return terms.select(
        key, "url",
        comparable(weighted(DOC_TITLE, parts, F.col("__cat"))).alias("d0"),
        comparable(weighted(DOC_CONTENT, parts, F.col("__cat"))).alias("d1"))


def borders(distances: DataFrame, key: str = "cluster") -> DataFrame:
    """Nearest and farthest member and mean distance per metric, as ``cluster_borders``."""
    aggregates: list[Column] = []
    for m in (0, 1):
        d = F.col(f"d{m}")
        aggregates += [F.min(F.struct(d, F.col("url"))).alias(f"lo{m}"),
                       # farthest, smallest url on ties
                       F.min(F.struct((-d).alias("d"), F.col("url"))).alias(f"hi{m}"),
                       F.avg(d).alias(f"avg{m}")]

    def border(m: int) -> Column:
        return F.struct(
            F.struct(F.col(f"lo{m}.url").alias("url"), F.col(f"lo{m}.d{m}").alias("distance")).alias("min"),
            F.struct(F.col(f"hi{m}.url").alias("url"), (-F.col(f"hi{m}.d")).alias("distance")).alias("max"),
            F.col(f"avg{m}").alias("avg"))
    return distances.groupBy(key).agg(*aggregates).select(key, F.array(border(0), border(1)).alias("cluster_borders"))


def profiles(docs: DataFrame, table: DataFrame, key: str = "cluster",
             vector: str = "content_embedding") -> DataFrame:
    """One row per topic that has documents: id, label, birth date, centroid, central document and
    borders. ``docs`` needs the key, the body columns and ``timestamp``."""
    means = centroids(docs, key, vector)
    central = central_documents(docs, means, key, vector)
    edge = borders(with_central_distances(docs, central, table, key, vector), key)
    heads = (docs.select(key, *BODY).join(central.select(key, "url"), [key, "url"])
             .select(key, F.struct(*BODY).alias("central_doc")))
    born = docs.groupBy(key).agg(F.min("timestamp").alias("timestamp"), F.count(F.lit(1)).alias("size"))
    return (born.join(means, key).join(heads, key).join(edge, key)
            .withColumn("label", id_label(F.col(key))))


def topic_sizes(rows: DataFrame, key: str = "cluster_id") -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("size"))


def category_profile(docs: DataFrame, key: str = "cluster") -> DataFrame:
    """Counted categories and the most common names per topic."""
    return counted_lists(category_counts(docs, key), key)


def modal_flag(flag: Column) -> Column:
    """Most frequent boolean of a group; a tie is false."""
    return 2 * F.count_if(flag) > F.count(F.lit(1))


def oversized(sizes: DataFrame, key: str = "cluster_id", size: str = "size", alpha: float = OUTLIER_ALPHA,
              minimum: int = OUTLIER_MIN_DOCS) -> DataFrame:
    """Non-noise topics larger than mean + alpha · population deviation, and than ``minimum``."""
    real = sizes.where(~is_noise(F.col(key)))
    limit = real.agg((F.avg(size) + F.lit(alpha) * F.stddev_pop(size)).alias("threshold"))
    # one aggregate row beside every topic
    return (real.withColumn("__one", F.lit(1)).join(F.broadcast(limit.withColumn("__one", F.lit(1))), "__one")
            .where((F.col(size) > F.col("threshold")) & (F.col(size) > minimum)).drop("__one"))
