"""Hard negatives by Strassen products of integer tiles and mergeable heaps."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, cut, rows_within
from .common import prepare_texts

#: Rows of a side of a tile; a task holds one tile's anchors and candidates.
TILE_ANCHORS, TILE_ROWS = 16_384, 16_384
#: Anchors and candidates that are multiplied at a time.
CHUNK_ANCHORS, CHUNK_ROWS = 1_024, 512
#: Matrices with a side of at most this length are multiplied directly.
LEAF = 16
#: Blocks of anchors that meet all candidates in one job; each copies the candidates once.
BLOCKS_AT_ONCE = 4
#: Squared length that a scaled vector must stay below: then no score of two rows leaves the range of a long.
MAX_SQUARE = 2.0 ** 62


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Product of two int64 matrices by seven half-size products, odd sides padded with zeros.

    Sums wrap around modulo 2^64 like all int64 arithmetic, so an entry is exact whenever it fits a long itself.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * h), np.int64)
    out[:i, :h] = p1 + p4 - p5 + p7
    out[:i, h:] = p3 + p5
    out[i:, :h] = p2 + p4
    out[i:, h:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The best ``size`` candidates per slot: higher scores first, then smaller places in the order of candidates.

    Heaps of the same slots merge by offering the entries of one to the other.
    """

    def __init__(self, slots: int, size: int):
        self.size = size
        self.slot, self.score, self.place = (np.empty(0, np.int64) for _ in range(3))
        #: Score that an entry needs at least to enter a slot.
        self.least = np.full(slots, np.iinfo(np.int64).min)

    def offer(self, slot: np.ndarray, score: np.ndarray, place: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, place = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.place, place)))
        order = np.lexsort((place, ~score, slot))
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        keep = rank < self.size
        order, self.slot = order[keep], slot[keep]
        self.score, self.place = score[order], place[order]
        full = rank[keep] == self.size - 1
        self.least[self.slot[full]] = self.score[full]


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as an int64 matrix; shorter rows are padded with zeros."""
    lists = vectors.combine_chunks()
    ends = lists.offsets.to_numpy()
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), width), np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], sizes)] = flat
    return out


def tile_heaps(anchors: pa.Table, rows: pa.Table, size: int, same: bool) -> pa.Table:
    """Best candidates of one tile: per anchor and window, or per anchor if there are no windows.

    ``anchors`` has a list of windows ``low`` to ``high`` of scores; ``rows`` is in the order that breaks ties.
    """
    a_lists, r_lists = anchors.column("v"), rows.column("v")
    width = max(int(np.diff(x.combine_chunks().offsets.to_numpy()).max(initial=0)) for x in (a_lists, r_lists))
    a, r = _matrix(a_lists, width), _matrix(r_lists, width)
    labels = pa.chunked_array([*anchors.column("label").chunks, *rows.column("label").chunks]).combine_chunks().dictionary_encode()
    codes = labels.indices.to_numpy()
    a_label, r_label = codes[:len(a)], codes[len(a):]
    a_row, r_row = anchors.column("row").to_numpy(), rows.column("row").to_numpy()
    low, high = (_matrix(anchors.column(c), max(1, int(np.diff(anchors.column(c).combine_chunks().offsets.to_numpy()).max(initial=0)))) for c in ("low", "high"))
    count = np.diff(anchors.column("low").combine_chunks().offsets.to_numpy())
    windows = low.shape[1]
    heaps = Heaps(len(a) * windows, size)
    for at in range(0, len(a), CHUNK_ANCHORS):
        mine = slice(at, at + CHUNK_ANCHORS)
        for start in range(0, len(r), CHUNK_ROWS):
            theirs = slice(start, start + CHUNK_ROWS)
            score = strassen(a[mine], np.ascontiguousarray(r[theirs].T))
            open_ = a_label[mine, None] == r_label[None, theirs]
            open_ = open_ & (a_row[mine, None] != r_row[None, theirs]) if same else ~open_
            for w in range(windows):
                slots = np.arange(at, at + len(score)) * windows + w
                least = np.maximum(low[mine, w], heaps.least[slots])
                hit = open_ & (score >= least[:, None]) & (score <= high[mine, w, None]) & (count[mine, None] > w)
                i, j = np.nonzero(hit)
                heaps.offer(slots[i], score[i, j], j + start)
    return pa.table({"anchor": a_row[heaps.slot // windows], "slot": heaps.slot % windows, "score": heaps.score, "row": r_row[heaps.place],
                     "k": rows.column("k").take(pa.array(heaps.place))})


def scaled(rows: DataFrame, *, key: str, vector: str, label: str, anchors: Column, scale: int) -> DataFrame:
    """Written table ``(row, k, label, anchor, v)`` of the rows that take part, with whole numbers for components."""
    numbers = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = F.forall("d", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate("f", F.lit(0.0), lambda s, x: s + x * x)
    return cut(rows.withColumn("__a", F.coalesce(anchors, F.lit(False)))
               .select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("k"), F.col(label).alias("label"),
                       F.col("__a").alias("anchor"), numbers.alias("d"))
               .where("label is not null and d is not null").where(usable)
               .withColumn("f", F.transform("d", lambda x: F.floor(x * float(scale)).cast("double")))
               .where(square < MAX_SQUARE).select("row", "k", "label", "anchor", F.transform("f", lambda x: x.cast("int")).alias("v")), "negatives-rows")


def best(anchors: DataFrame, rows: DataFrame, parts: DataFrame | None, size: int, *, same: bool, name: str) -> DataFrame:
    """``(anchor, slot, rank, score, row, k)``: the best ``size`` rows per anchor and window of it, over all rows.

    Anchors and rows are dealt into blocks, and each pair of blocks of one part is a tile of bounded size. A tile
    returns its heaps, which merge by rank. Blocks of anchors are taken a few at a time, so that the copies of the
    rows on disk stay bounded. ``parts`` has ``(label, part, na, nr)``: rows of other parts never meet.
    """
    def dealt(df: DataFrame, own: str, blocks: str) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("row"), F.col(blocks)).cast("int"))

    sides = []
    for df in (anchors, rows):
        if parts is None:
            sides.append(df.withColumn("part", F.lit(0).cast("long")))
        else:
            sides.append(df.join(parts, "label"))
    if parts is None:
        na, nr = -(-anchors.count() // TILE_ANCHORS), -(-rows.count() // TILE_ROWS)
        sides = [s.withColumn("na", F.lit(max(1, na))).withColumn("nr", F.lit(max(1, nr))) for s in sides]
        most = na
    else:
        most = parts.agg(F.max("na")).first()[0] or 0
    left, right = dealt(sides[0], "ab", "na"), dealt(sides[1], "rb", "nr")
    tile = ["part", "ab", "rb"]
    fields = "anchor long, slot int, score long, row long, k long"

    def run(both: pa.Table) -> pa.Table:
        schema = pa.schema([("anchor", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("row", pa.int64()), ("k", pa.int64())])
        mine = both.column("own")
        a, r = both.filter(mine), both.filter(pc.invert(mine))
        if not len(a) or not len(r):
            return schema.empty_table()
        return tile_heaps(a, r.sort_by([("k", "ascending"), ("row", "ascending")]), size, same).cast(schema)

    none = [F.lit(None).cast("array<long>").alias(c) for c in ("low", "high")]
    found = []
    for start in range(0, most, BLOCKS_AT_ONCE):
        a = (left.where(F.col("ab").between(start, start + BLOCKS_AT_ONCE - 1)).withColumn("rb", F.explode(F.sequence(F.lit(0), F.col("nr") - 1)))
             .select(*tile, F.lit(True).alias("own"), "row", "label", "v", F.lit(None).cast("long").alias("k"), "low", "high"))
        last = F.least(F.col("na"), F.lit(start + BLOCKS_AT_ONCE)) - 1
        r = (right.where(F.col("na") > start).withColumn("ab", F.explode(F.sequence(F.lit(start), last)))
             .select(*tile, F.lit(False).alias("own"), "row", "label", "v", "k", *none))
        heaps = a.unionByName(r).groupBy(*tile).applyInArrow(run, fields)
        order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.col("k").asc_nulls_last(), "row")
        found.append(cut(heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size), name))
    if not found:
        return anchors.sparkSession.createDataFrame([], f"{fields}, rank int")
    return reduce(DataFrame.unionByName, found)


def label_parts(rows: DataFrame) -> DataFrame:
    """``(label, part, na, nr)``: a label of more rows than a tile is a part of several blocks, smaller ones share parts of one."""
    counts = cut(rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("anchor"), 1)).alias("a")), "negatives-labels")
    large = F.col("n") > TILE_ROWS
    small = counts.agg(F.sum(F.when(~large, F.col("n")))).first()[0] or 0
    shared = max(1, -(-small // TILE_ROWS))
    parts = counts.select("label", F.when(large, F.xxhash64("label", F.lit(1))).otherwise(F.pmod(F.xxhash64("label"), F.lit(shared))).alias("part"),
                          F.when(large, F.ceil(F.greatest(F.col("a"), F.lit(1)) / TILE_ANCHORS)).otherwise(1).cast("int").alias("na"),
                          F.when(large, F.ceil(F.col("n") / TILE_ROWS)).otherwise(1).cast("int").alias("nr"))
    return F.broadcast(parts) if rows_within(counts, BROADCAST_ROWS) is not None else parts


def hard_negatives(rows: DataFrame, *, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components count as ``floor(scale x)`` and a score is the integer inner product. An anchor's positives are its best
    ``positives`` other rows of its label, and a positive's negatives the best ``negatives`` rows of another label
    that score from ``low`` to ``high`` percent of the positive's score; ties go to the smaller key.

    Rows with a null label, a null vector, or a null or non-finite component take no part, nor do rows whose scaled
    vector has a length of 2^31 or more, whose scores might not fit a long. Rows without a key are no anchors
    unless ``anchors`` says so, and come last among equal scores. Each row counts for itself, also rows with equal
    keys or alike in all columns; they share ids in the result. Vectors may differ in length: missing components are
    zero. An anchor without positives, or a positive without negatives, gives no rows, and so does an
    empty table. Other columns are ignored.
    """
    prepare_texts(rows.sparkSession)
    table = scaled(rows, key=key, vector=vector, label=label, anchors=anchors, scale=scale)
    chosen = table.where("anchor").select("row", "k", "label", "v")
    every = [F.array(F.lit(x).cast("long")) for x in (-2 ** 63, 2 ** 63 - 1)]
    near = best(chosen.withColumn("low", every[0]).withColumn("high", every[1]), table, label_parts(table), positives, same=True, name="negatives-positives")
    near = near.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("k").alias("positive_id"), F.col("score").alias("positive_score"))

    def share(percent: int, up: bool) -> Column:
        """``percent`` of a score, rounded up or down, without leaving the range of a long."""
        score = F.col("positive_score")
        rest = F.pmod(score, F.lit(100))
        part = F.floor((F.lit(percent) * rest + (99 if up else 0)) / 100)
        return F.expr("(positive_score - pmod(positive_score, 100L)) div 100") * percent + part

    bounds = (near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("slot", share(low, True).alias("low"), share(high, False).alias("high")))).alias("w"))
              .select(F.col("anchor").alias("row"), F.col("w.low").alias("low"), F.col("w.high").alias("high")))
    windows = cut(chosen.join(bounds, "row"), "negatives-windows")
    far = best(windows, table, None, negatives, same=False, name="negatives-negatives")
    ids = chosen.select(F.col("row").alias("anchor"), F.col("k").alias("anchor_id"))
    return (far.select("anchor", "slot", "rank", F.col("k").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(near, ["anchor", "slot"]).join(ids, "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
