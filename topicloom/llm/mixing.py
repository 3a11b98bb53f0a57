"""Mixing of sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .common import WORD, prepare_texts, whole, words_sql

#: Weights given to the sources in order of their names, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Documents that one slice of a source's key range holds on average.
SLICE_DOCS = 2_000
#: Characters that lower the quality of a text.
POOR = r"[0-9#*$%&|<>{}\[\]=_/\\~^+@]"


def quality(text: Column) -> Column:
    """Weight of a document, 0.25 to 1: less for a text with a large share of digits and symbols."""
    n = F.length(text)
    share = F.when(n > 0, F.regexp_count(text, F.lit(POOR)) / n).otherwise(F.lit(1.0))
    return F.greatest(F.lit(0.25), F.lit(1.0) - F.lit(2.0) * share)


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) that follows from the key and the seed."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), key.cast("string")))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = 3.0) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    All words are shared by weight; a target ends at ``limit`` times its source and the rest is shared again. The
    sources that end at their limit are those with the least room per weight, so one pass in that order settles
    all: a source is at its limit if it would be with everything before it at its limit. The two windows see one
    row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.array(*map(F.lit, weights))[(F.row_number().over(order) - 1) % len(weights)]
    rows = sizes.withColumn("w", pick).withColumn("room", F.lit(limit) * F.col("source_size"))
    by_room = Window.orderBy(F.col("room") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    rows = (rows.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("room").over(before), F.lit(0.0)))
            .withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
            .withColumn("full", F.col("room") <= F.col("left") / F.col("w_left") * F.col("w"))
            .withColumn("full", F.min("full").over(by_room.rowsBetween(Window.unboundedPreceding, 0))))
    rest = F.sum("source_size").over(everything) - F.sum(F.when(F.col("full"), F.col("room")).otherwise(0.0)).over(everything)
    w_rest = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(everything)
    return rows.select("source", "source_size", F.when(F.col("full"), F.col("room"))
                       .otherwise(rest / w_rest * F.col("w")).alias("target"))


def mix(docs: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, limit: float = 3.0, seed: str = "mix",
        key: str = "doc_id", source: str = "source", text: str = "text", slice_docs: int = SLICE_DOCS,
        row: str | None = None) -> DataFrame:
    """``(key, size, source, source_size, target, epochs, taken)`` for each row of ``docs``.

    ``target / source_size`` complete epochs take every document; the rest of the budget goes to documents in
    ascending order of exponential keys ``-ln(u) / quality`` (Efraimidis and Spirakis), each whole but for the last
    one, which gives the words that are left. ``taken`` counts words with repeats.

    The running sum does not sort a source: keys are cut into slices of about ``slice_docs`` documents, slices are
    summed, and only the one slice in which a budget ends is put in order. A source with a third of all rows
    costs one aggregate like any other.

    Null text has size 0, a null source is a source of its own (last), null and repeated keys keep their rows
    (equal keys are ordered by size); an empty table gives an empty result. Other columns are ignored, but for a
    number ``row`` of each row, which is passed on and orders equal keys of one size.
    """
    prepare_texts(docs.sparkSession)
    passed = [] if row is None else [F.col(row).alias("row")]
    t = whole(text)
    u = uniform(F.coalesce(F.col(key).cast("string"), F.lit("")), seed)
    rows = cut(docs.select(F.col(key).alias("k"), F.col(source).alias("source"),
                           F.regexp_count(t, F.lit(WORD)).cast("long").alias("size"), (-F.log(u) / quality(t)).alias("e"), *passed),
               "mix-rows")
    per_source = cut(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), "mix-sources")
    targets = source_targets(per_source.select("source", "source_size"), weights, limit)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = cut(targets.join(per_source.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
               .withColumn("epochs", epochs)
               .withColumn("budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
               .withColumn("slices", F.ceil(F.col("n") / slice_docs).cast("long")), "mix-plan")
    # with weights near 1, 1 - exp(-key) is nearly uniform, so slices are nearly even
    part = F.least(F.floor((F.lit(1.0) - F.exp(-F.col("e"))) * F.col("slices")).cast("long"), F.col("slices") - 1)
    same = F.col("source").eqNullSafe(F.col("s"))
    placed = rows.join(plan.withColumnRenamed("source", "s"), same).drop("s").withColumn("part", part)
    sums = placed.groupBy("source", "part").agg(F.sum("size").alias("m"))
    behind = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("part").alias("p"), "m", F.coalesce(F.sum("m").over(behind), F.lit(0)).alias("before"))
    ends = cut(sums.join(plan.select("source", "budget"), F.col("source").eqNullSafe(F.col("s")))
               .where((F.col("before") < F.col("budget")) & (F.col("before") + F.col("m") >= F.col("budget")))
               .select("s", F.col("p").alias("last"), "before"), "mix-ends")
    # no slice ends a budget of nothing, and then none is taken from
    placed = placed.join(ends, same, "left").drop("s").withColumn("last", F.coalesce("last", F.lit(-1)))
    inside = F.col("part") == F.col("last")
    clear = placed.where(~inside).withColumn("part_taken", F.when(F.col("part") < F.col("last"), F.col("size")).otherwise(F.lit(0)))
    run = Window.partitionBy("source").orderBy("e", "k", "size", *(["row"] if passed else [])).rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("budget") - F.col("before") - F.coalesce(F.sum("size").over(run), F.lit(0))
    edge = placed.where(inside).withColumn("part_taken", F.greatest(F.lit(0), F.least("size", room)))
    return (clear.unionByName(edge)
            .select(F.col("k").alias(key), "size", F.col("source").alias(source), "source_size", "target", "epochs",
                    (F.col("epochs") * F.col("size") + F.col("part_taken")).cast("long").alias("taken"),
                    *([F.col("row").alias(row)] if passed else [])))


def mixed_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents as the mix takes them: one row per copy with the columns of ``docs``; a last copy that is
    taken in part holds that many of the document's words. What is taken belongs to rows, not to keys. Null and empty
    texts have no words and are not taken; all columns pass through, whatever their names; an empty table gives an empty one."""
    prepare_texts(docs.sparkSession)
    rows = cut(docs.select(F.struct("*").alias("d"), F.monotonically_increasing_id().alias("row")), "mix-docs")
    names = [key, text, options.get("source", "source")]
    texts = rows.select(*[F.col(f"d.`{c}`").alias(f"c{i}") for i, c in enumerate(names)], "row")
    taken = (mix(texts, **options | {"key": "c0", "text": "c1", "source": "c2"}, row="row").where("taken > 0")
             .select("row", F.col("taken").alias("words"), "size"))
    rows = rows.join(taken, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("words") / F.col("size")).cast("int"))))
    kept = F.col("words") - (F.col("copy") - 1) * F.col("size")
    part = F.array_join(F.slice(F.expr(words_sql(f"d.`{text}`")), F.lit(1), kept.cast("int")), " ")
    new = F.when(kept >= F.col("size"), F.col(f"d.`{text}`")).otherwise(part)
    return rows.select(*[new.alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns])
