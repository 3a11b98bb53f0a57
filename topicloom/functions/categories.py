"""Category helpers: list cleaning, category terms of pairs, shares and top categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, cut, rows_within
from ..settings import TOP_CATEGORIES, UNKNOWN_CATEGORY


def known(categories: Column) -> Column:
    """Categories without the ``unknown`` marker; NULL counts as empty."""
    kept = F.filter(categories, lambda c: c != UNKNOWN_CATEGORY)
    return F.coalesce(kept, F.array().cast("array<string>"))


def equal_shares(categories: Column) -> Column:
    """``1/n`` for each of n categories, which makes the category term a mean."""
    n = F.size(categories)
    return F.array_repeat(F.lit(1.0) / F.when(n > 0, n), n)


def with_category_distance(pairs: DataFrame, left: str, right: str, table: DataFrame,
                           name: str = "category_distance") -> DataFrame:
    """Add the document category distance of two list columns.

    Mean over the cross product of both lists without ``unknown``; a pair the table does not
    list counts 1, an empty side makes the whole term 1, the mean is clamped to [0, 1]. Lists
    repeat far more often than documents, so the mean is taken once per distinct pair of lists
    and joined back. The means are written, and broadcast if a count proves them small: a frequent
    pair of lists then gathers its rows in no task.
    """
    a, b = "__a", "__b"
    keyed = pairs.withColumn(a, known(F.col(left))).withColumn(b, known(F.col(right)))
    distinct = keyed.select(a, b).distinct()
    crossed = (distinct.withColumn("__x", F.explode(a)).withColumn("__y", F.explode(b))
               .withColumn("__lo", F.least("__x", "__y")).withColumn("__hi", F.greatest("__x", "__y")))
    listed = table.select(F.col("first_category").alias("__lo"), F.col("second_category").alias("__hi"),
                          F.col("distance").alias("__d"))
    means = (crossed.join(listed, ["__lo", "__hi"], "left")
             .groupBy(a, b).agg(F.avg(F.coalesce("__d", F.lit(1.0))).alias("__mean")))
    clamped = F.greatest(F.least(F.coalesce("__mean", F.lit(1.0)), F.lit(1.0)), F.lit(0.0))
    means = cut(means, "category-means")
    if rows_within(means, BROADCAST_ROWS) is not None:
        means = F.broadcast(means)
    return keyed.join(means, [a, b], "left").withColumn(name, clamped).drop(a, b, "__mean")


def category_counts(rows: DataFrame, key: str, categories: str = "categories") -> DataFrame:
    """``(key, category, n)`` of a plain category list column."""
    return (rows.select(key, F.explode(categories).alias("category"))
            .groupBy(key, "category").agg(F.count(F.lit(1)).alias("n")))


def counted_lists(counts: DataFrame, key: str, k: int = TOP_CATEGORIES) -> DataFrame:
    """Per key: the counted multiset and the ``k`` most common names (ties by name).

    One array holds at most one entry per category of the vocabulary.
    """
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "category")))
    return counts.groupBy(key).agg(ranked.alias("__r")).select(
        key,
        F.transform("__r", lambda e: F.struct(e["category"].alias("category"),
                                              (-e["o"]).alias("n"))).alias("categories"),
        F.transform(F.slice("__r", 1, k), lambda e: e["category"]).alias("most_common_categories"))


def leading_shares(counted: Column, k: int = 1) -> Column:
    """First ``k`` entries of a counted multiset with their share of the whole list."""
    total = F.aggregate(counted, F.lit(0).cast("long"), lambda s, e: s + e["n"])
    ordered = F.array_sort(F.transform(counted, lambda e: F.struct((-e["n"]).alias("o"),
                                                                   e["category"].alias("category"))))
    return F.transform(F.slice(ordered, 1, k),
                       lambda e: F.struct(e["category"].alias("category"),
                                          ((-e["o"]) / total).alias("share")))


def with_shared_category_term(pairs: DataFrame, left: str, right: str, table: DataFrame, use_shares: bool = True,
                              name: str = "category_term") -> DataFrame:
    """Add the cluster category term of two ``leading_shares`` columns: the listed distances of all
    pairs, times both shares if ``use_shares``; a pair the table does not list adds nothing."""
    distinct = pairs.select(F.col(left).alias("__a"), F.col(right).alias("__b")).distinct()
    crossed = (distinct.withColumn("__x", F.explode("__a")).withColumn("__y", F.explode("__b"))
               .withColumn("__lo", F.least("__x.category", "__y.category"))
               .withColumn("__hi", F.greatest("__x.category", "__y.category")))
    listed = table.select(F.col("first_category").alias("__lo"), F.col("second_category").alias("__hi"),
                          F.col("distance").alias("__d"))
    factor = F.col("__x.share") * F.col("__y.share") if use_shares else F.lit(1.0)
    sums = (crossed.join(listed, ["__lo", "__hi"]).groupBy("__a", "__b")
            .agg(F.sum(F.col("__d") * factor).alias("__s"))
            .select(F.col("__a").alias(left), F.col("__b").alias(right), "__s"))
    return pairs.join(sums, [left, right], "left").withColumn(name, F.coalesce("__s", F.lit(0.0))).drop("__s")
