"""Consecutive numbers for the distinct keys of a table, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def number_keys(rows: DataFrame, keys: list[str], name: str = "ordinal") -> DataFrame:
    """Distinct ``keys`` with numbers 0, 1, … in ascending key order.

    A range partitioned sort fixes the order, each partition counts its rows, and the offset of a
    partition is the running sum over one row per partition.
    """
    ordered = (rows.select(*keys).distinct().repartitionByRange(*keys).sortWithinPartitions(*keys)
               .withColumn("__m", F.monotonically_increasing_id()))
    ordered = cut(ordered, "ordinal")
    pid, pos = F.shiftright("__m", 33), F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ordered.groupBy(pid.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__p", F.coalesce(before, F.lit(0)).alias("__o"))
    return (ordered.withColumn("__p", pid).join(offsets, "__p")
            .select(*keys, (F.col("__o") + pos).alias(name)))


def number_within(rows: DataFrame, part: str, key: str, name: str = "ordinal") -> DataFrame:
    """Distinct ``(part, key)`` numbered from 0 in key order inside each part."""
    numbered = number_keys(rows, [part, key], "__g")
    first = numbered.groupBy(part).agg(F.min("__g").alias("__f"))
    return numbered.join(first, part).select(part, key, (F.col("__g") - F.col("__f")).alias(name))
