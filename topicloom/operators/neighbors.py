"""ε-neighbourhoods: which points of a table lie within ``eps`` of each other.

Points are dealt into blocks of bounded size, Spark ships every pair of blocks that may hold a
match to one task, and the task compares the two blocks with matrix products (see ``kernel``).

* No task ever holds more than two blocks, whatever the size of a part or of a topic.
* Parts smaller than a block are packed together, so many small parts cost few tasks.
* Large parts get *anchors*, a bounded uniform sample. Every point joins the cell of its nearest
  anchor. Two cells whose points are provably further apart than the radius are never compared, and of a cell
  that meets another one only the points that may be near some point of it are sent there.
* When only connectivity is asked for, points within ``eps`` of connected anchors form one *solid*
  group that needs no comparison among itself. A topic with a third of all rows is almost surely
  solid: it costs one comparison per row and anchor instead of all its pairs. Tasks return a
  spanning forest instead of their edges.

All of this is exact: no pair is skipped that could be within ``eps``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, cut, is_empty, rows_within
from ..settings import DIGITS, Metric
from .dense import Meeting
from .kernel import PAIRS, STRIP_PAIRS, Block, category_table, category_terms, exact, unite, vectors, within
from .lookup import CategoryPairs

#: Rows of a block: the larger the blocks, the fewer copies of a row are shuffled; the bound keeps a
#: task at two blocks of moderate size. Small tables use small blocks to have tiles for all cores.
BLOCK_ROWS, LARGE_BLOCK_ROWS = 2_048, 65_536
BLOCK_VALUES = 8_000_000
#: Parts of more blocks than this get anchors.
ANCHOR_BLOCKS = 8
#: Pairs of points handed to the caller's own distance at once.
OWN_PAIRS = 2_048
#: Anchors grow with the blocks of the table up to a bound that keeps their statistics small.
FEW_ANCHORS, MANY_ANCHORS = 64, 1_024

LEFT, RIGHT, BOTH = 0, 1, 2


@dataclass
class Tiles:
    """Rows keyed by the tile (pair of blocks) they take part in."""

    rows: DataFrame
    #: links found while placing the points, or None
    links: DataFrame | None
    #: True when no part spans more than one block
    single: bool


# -- placing points ----------------------------------------------------------------------------

def block_size(points: DataFrame, metric: Metric, rows: int, blocks: int = 32) -> int:
    """Rows per block for a table whose largest part has ``rows`` rows, to be dealt into about ``blocks`` blocks."""
    wanted = min(LARGE_BLOCK_ROWS, rows // blocks)
    if wanted <= BLOCK_ROWS:
        return BLOCK_ROWS
    width = points.select(sum((F.size(c) for c in metric.columns), F.lit(0))).first()[0]
    return max(256, min(wanted, BLOCK_VALUES // max(1, width)))


def place(points: DataFrame, metric: Metric, eps: float, categories: CategoryPairs, *, connect: bool,
          block_rows: int | None = None, anchor_blocks: int = ANCHOR_BLOCKS, written: bool = False) -> Tiles:
    """Replicate points to the tiles they must be compared in. With ``connect`` solid groups are
    left out and their links returned. ``written`` points are read again rather than written once more."""
    sizes = cut(points.groupBy("part").agg(F.count(F.lit(1)).alias("__n")), "sizes")
    total, biggest = sizes.agg(F.sum("__n"), F.max("__n")).first()
    # without a radius every two blocks of a part meet, so fewer give tiles enough
    block_rows = block_rows or block_size(points, metric, biggest or 0, categories.blocks(8 if math.isinf(eps) else 16))
    bins = max(1, math.ceil((total or 0) / block_rows))
    packed = F.concat(F.lit("p"), F.pmod(F.xxhash64("part"), F.lit(bins)))
    if not total or biggest <= block_rows:
        rows = points.withColumn("tile", packed).withColumn("side", F.lit(BOTH))
        return Tiles(rows, None, True)

    large = _small(sizes.where(F.col("__n") > block_rows))
    small_rows = (points.join(large, "part", "left_anti")
                  .withColumn("tile", packed).withColumn("side", F.lit(BOTH)))
    # no radius, no cells out of reach: blocks alone then cost the fewest copies
    if math.isinf(eps) or biggest <= anchor_blocks * block_rows:
        blocks = F.ceil(F.col("__n") / block_rows).cast("int")
        rows = (points.join(large, "part").withColumn("__k", blocks)
                .withColumn("__b", F.pmod(F.xxhash64("id"), F.col("__k")).cast("int")))
        tile = F.transform(F.sequence(F.lit(0), F.col("__k") - 1), lambda o: F.struct(
            F.concat_ws(":", F.lit("b"), F.col("part"), F.least("__b", o), F.greatest("__b", o)).alias("tile"),
            F.when(o == F.col("__b"), BOTH).when(o > F.col("__b"), LEFT).otherwise(RIGHT).alias("side")))
        rows = rows.withColumn("__t", F.explode(tile)).select(
            *points.columns, F.col("__t.tile").alias("tile"), F.col("__t.side").alias("side"))
        return Tiles(small_rows.unionByName(rows), None, False)

    # Points are compared with anchors before there are tiles. A table that is sent to tiles counts as one that lists
    # nothing there, which finds only links that exist, if nothing is further apart than what is not listed.
    connect = connect and (categories.shared is not None or metric.missing >= 1 and not metric.cap)
    anchors = min(MANY_ANCHORS, max(FEW_ANCHORS, 16 * bins))
    points = points if written else cut(points, "points")
    rows, links = _place_by_anchors(points.join(_small(large.select("part")), "part", "left_semi"), points.columns,
                                    metric, eps, categories, connect, block_rows, anchors)
    return Tiles(small_rows.unionByName(rows), links, False)


def _small(table: DataFrame) -> DataFrame:
    """The table, to be broadcast if a count proves it small: rows that are joined with it are then not shuffled."""
    return F.broadcast(table) if rows_within(table, BROADCAST_ROWS) is not None else table


def _anchors(points: DataFrame, metric: Metric, n: int) -> pa.Table:
    """A uniform sample that does not depend on how the points are partitioned."""
    return points.select("id", "part", *metric.columns, "cats", "shares").orderBy(F.xxhash64("id"), "id").limit(n).toArrow()


def _cells(points: DataFrame, sample: pa.Table, metric: Metric, eps: float, categories: CategoryPairs, connect: bool, marks: bool = False) -> DataFrame:
    """The points with the ``cell`` of their nearest anchor (-1 in a part without one) and with ``connect`` an anchor within
    ``eps``. With ``marks`` a written table of these without the vectors, some rows of which also say how far their cell goes
    towards the others and which anchors a batch connects: points are large, so the cells are found once more where points
    are read.

    Points further from their anchor than the radius form a cell of their own, numbered after all anchors: a few
    scattered points then do not bring the whole cell in reach of others."""
    owner = np.asarray(sample.column("part").to_pylist(), dtype=object)
    gate, radius = metric.gate[0], eps / metric.gate[1]
    shared, unlisted = categories.shared, category_table([], [], [])

    def annotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            n = table.num_rows
            cell, star = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
            reach: list = [None] * n
            bound: list = [None] * n
            parts = np.asarray(table.column("part").to_pylist(), dtype=object)
            for part in sorted(set(parts)):
                at, to = np.nonzero(parts == part)[0], np.nonzero(owner == part)[0]
                if not len(to):
                    continue
                x = Block(table.take(pa.array(at)), metric.columns)
                a = Block(sample.take(pa.array(to)), metric.columns)
                sq = np.maximum(x.sq[gate][:, None] + a.sq[gate][None, :] - 2 * x.vec[gate] @ a.vec[gate].T, 0)
                home = sq.argmin(axis=1)
                far = np.sqrt(sq[np.arange(len(at)), home]) > radius
                cell[at] = to[home] + len(owner) * far
                if connect:
                    meet = Meeting(x, a, metric, shared.value if shared else unlisted, eps)
                    first = meet.smallest(eps, np.arange(len(to)), len(to))
                    hit = first < len(to)
                    star[at[hit]] = to[first[hit]]
                if not marks:
                    continue
                between = np.sqrt(np.maximum(a.sq[gate][:, None] + a.sq[gate][None, :]
                                             - 2 * a.vec[gate] @ a.vec[gate].T, 0))
                for own in np.unique(cell[at]):
                    mine = np.nonzero(cell[at] == own)[0]
                    h = home[mine[0]]
                    # coordinate of each point on the line from its own anchor to every other one
                    with np.errstate(divide="ignore", invalid="ignore"):
                        along = (sq[mine, h][:, None] - sq[mine]) / (2 * between[h])
                    along = np.where(between[h] > 1e-6, along, 0.0).max(axis=0)
                    spread = np.full(len(owner) + 2, np.nan, np.float32)
                    spread[to] = np.nextafter(along.astype(np.float32), np.float32(np.inf))
                    away = np.sqrt(sq[mine, h])
                    spread[-2:] = np.nextafter(np.float32([away.max(), -away.min()]), np.float32(np.inf))
                    bound[at[mine[0]]] = spread
                if connect:
                    joined = np.arange(len(to) + len(at))
                    meet.connect(eps, joined, len(to) + np.arange(len(at)), np.arange(len(to)))
                    joined = joined[:len(to)]
                    moved = np.nonzero(joined != np.arange(len(to)))[0]
                    reach[at[0]] = [{"a": int(to[m]), "b": int(to[joined[m]])} for m in moved]
            table = table.append_column("cell", pa.array(cell, pa.int32())).append_column("star", pa.array(star, pa.int32()))
            if marks:
                table = (table.select(["id", "part", "cell", "star"])
                         .append_column("reach", pa.array(reach, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))))
                         .append_column("bound", pa.array(bound, pa.list_(pa.float32()))))
            yield from table.to_batches()

    if marks:
        return cut(points.mapInArrow(annotate, "id string, part string, cell int, star int, reach array<struct<a:int,b:int>>, bound array<float>"), "cells")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema.fields)
    return points.mapInArrow(annotate, f"{fields}, cell int, star int")


def _reach(placed: DataFrame) -> DataFrame:
    """``(cell, home, other, t)``: the furthest that a point of a cell lies on the line from its anchor to another one.
    Two more rows, numbered after all anchors, tell its largest distance from its anchor and the smallest one, negated."""
    bounds = placed.where("bound is not null").select("cell", F.pmod("cell", F.size("bound") - 2).alias("home"), F.posexplode("bound").alias("other", "t"))
    return bounds.where("not isnan(t)").groupBy("cell", "home", "other").agg(F.max("t").cast("double").alias("t"))


def _open_cells(one: DataFrame, two: DataFrame, metric: Metric, eps: float) -> DataFrame:
    """``(cell, other)``: cells of the first table that may hold a point within ``eps`` of one in a cell of the second.
    Cells i and j are at least -T(i,j) - T(j,i) apart, T = furthest reach of a cell towards the other's anchor."""
    mirrored = two.select(F.col("cell").alias("met"), F.col("home").alias("other"), F.col("other").alias("home"), F.col("t").alias("u"))
    unplaced = one.sparkSession.range(1).select(F.lit(-1).alias("cell"), F.lit(-1).alias("other"))
    return (one.join(mirrored, ["home", "other"])
            .where((F.col("home") == F.col("other")) | (-(F.col("t") + F.col("u")) * metric.gate[1] <= eps + 1e-5))
            .select("cell", F.col("met").alias("other")).unionByName(unplaced))


def _rank(sample: pa.Table, metric: Metric) -> Column:
    """Place of a ``cell`` in an order in which neighbours are close, scattered points last; -1 without an anchor."""
    rank = np.argsort(nearby_order(vectors(sample, metric.gate[0])))
    rank = np.concatenate([rank, len(rank) + rank])
    return F.when(F.col("cell") >= 0, F.get(F.array(*[F.lit(int(r)) for r in rank]), F.col("cell"))).otherwise(-1)


def _bundles(placed: DataFrame, rank: Column, block_rows: int, *within: str) -> DataFrame:
    """Written table ``(part, cell, *within, bundle, k)``: neighbouring cells that agree in ``within`` form bundles of
    about a block; a crowded cell is a bundle of its own, cut into ``k`` blocks."""
    n = placed.groupBy("part", "cell", *within).agg(F.count(F.lit(1)).alias("n"))
    # at most one row per anchor and value of ``within`` in all, and one for each part without anchors
    before = Window.partitionBy("part", *within).orderBy(rank)
    crowded = F.col("n") >= block_rows
    small = F.sum(F.when(crowded, 0).otherwise(F.col("n"))).over(before)
    bundle = F.when(crowded, F.concat_ws("|", F.lit("c"), *within, "cell")).otherwise(
        F.concat_ws("|", F.lit("s"), *within, F.floor((small - 1) / block_rows)))
    k = F.when(crowded, F.ceil(F.col("n") / block_rows)).otherwise(1).cast("int")
    return cut(n.select("part", "cell", *within, bundle.alias("bundle"), k.alias("k")), "bundles")


def _with_meets(placed: DataFrame, sample: pa.Table, reach: DataFrame, others: DataFrame, metric: Metric, eps: float) -> DataFrame:
    """The placed points with ``meets``: hashes of the bundles (``others``) that may hold a point within ``eps`` of them.

    ``reach`` are the bounds of the others' cells, at most as many as two squares of the anchors. A point x may be near a
    point of cell j only if x lies no further than the radius from the cell's reach on the line between their anchors,
    and its distance from j's anchor no further from the distances found in j. Unlike bounds between whole cells, this
    holds scattered points apart from all cells but a few, and these from them."""
    owner = np.asarray(sample.column("part").to_pylist(), dtype=object)
    gate, radius = metric.gate[0], (eps + 1e-5) / metric.gate[1]
    found = reach.select("cell", "other", F.col("t").cast("float").alias("t")).toArrow()
    spread = np.full((2 * len(owner), len(owner) + 2), np.nan, np.float32)
    spread[found.column("cell").to_numpy(), found.column("other").to_numpy()] = found.column("t").to_numpy()
    names = others.where("cell >= 0").select("part", "cell", F.xxhash64("part", "bundle").alias("name")).toArrow().sort_by([("name", "ascending")])
    spread, names = (placed.sparkSession.sparkContext.broadcast(v) for v in (spread, names))

    def annotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.asarray(names.value.column("part").to_pylist(), dtype=object)
        cells, hashes = names.value.column("cell").to_numpy(), names.value.column("name").to_numpy()
        for batch in batches:
            table = pa.Table.from_batches([batch])
            cell = table.column("cell").to_numpy()
            parts = np.asarray(table.column("part").to_pylist(), dtype=object)
            at_all, met_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            vec = vectors(table, gate)
            vsq = np.einsum("ij,ij->i", vec, vec)
            for part in sorted(set(parts)):
                to, own = np.nonzero(owner == part)[0], np.nonzero(held == part)[0]
                if not len(to) or not len(own):
                    continue
                anchor = vectors(sample.take(pa.array(to)), gate)
                asq = np.einsum("ij,ij->i", anchor, anchor)
                between = np.sqrt(np.maximum(asq[:, None] + asq[None, :] - 2 * anchor @ anchor.T, 0))
                target, heads = cells[own], np.nonzero(np.append(True, hashes[own][1:] != hashes[own][:-1]))[0]
                far_end = np.searchsorted(to, target % len(owner))
                bounds = spread.value[target].astype(float)
                # distances come from matrix products, which leave an error that grows with the vectors
                limit = radius + 1e-6 * float(np.sqrt(max(asq.max(), vsq.max())))
                rows = np.nonzero(parts == part)[0]
                step = max(1, STRIP_PAIRS // len(target))
                for start in range(0, len(rows), step):
                    at = rows[start:start + step]
                    home = np.searchsorted(to, cell[at] % len(owner))
                    sq = np.maximum(vsq[at, None] + asq[None, :] - 2 * vec[at] @ anchor.T, 0)
                    gap = between[home]
                    with np.errstate(divide="ignore", invalid="ignore"):
                        along = np.where(gap > 1e-6, (sq[np.arange(len(at)), home][:, None] - sq) / (2 * gap), 0.0)
                    away = np.sqrt(sq)[:, far_end]
                    open_ = (far_end[None, :] == home[:, None]) | (-(along[:, far_end] + bounds[:, to].T[home]) <= limit)
                    open_ &= (away <= bounds[:, -2] + limit) & (away >= -bounds[:, -1] - limit)
                    i, j = np.nonzero(np.logical_or.reduceat(open_, heads, axis=1))
                    at_all.append(at[i])
                    met_all.append(hashes[own][heads][j])
            at, met = np.concatenate(at_all), np.concatenate(met_all)
            order = np.argsort(at, kind="stable")
            ends = np.append(0, np.cumsum(np.bincount(at, minlength=len(cell))))
            meets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(met[order], pa.int64()))
            yield from table.append_column("meets", meets).to_batches()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields)
    return placed.mapInArrow(annotate, f"{fields}, meets array<long>")


def _sent_to(placed: DataFrame, bundles: DataFrame, met: DataFrame, within: list[str]) -> DataFrame:
    """The placed points with their bundle, once for each bundle that theirs meets and that may hold a point near them.
    Both tables are broadcast if a count proves them small, so that the points wait for their tiles and are not shuffled
    before."""
    few = rows_within(bundles, BROADCAST_ROWS) is not None and rows_within(met, BROADCAST_ROWS) is not None
    small = F.broadcast if few else (lambda table: table)
    met = met.withColumn("oname", F.xxhash64("part", "obundle"))
    rows = placed.join(small(bundles), ["part", "cell", *within]).join(small(met), ["part", "bundle"])
    return rows.where((F.col("cell") < 0) | F.array_contains("meets", F.col("oname")))


def _place_by_anchors(points: DataFrame, columns: list[str], metric: Metric, eps: float,
                      categories: CategoryPairs, connect: bool, block_rows: int, anchors: int) -> tuple[DataFrame, DataFrame | None]:
    sample = _anchors(points, metric, anchors)
    anchor_ids = sample.column("id").to_pylist()
    placed = _cells(points, sample, metric, eps, categories, connect, marks=True)

    # anchors joined by some point; at most the square of their number, as small integers
    merged = np.arange(len(anchor_ids))
    if connect:
        joins = placed.select(F.inline("reach")).distinct().toPandas()
        unite(merged, joins.a.to_numpy(dtype=int), joins.b.to_numpy(dtype=int))
    solid = F.when(F.col("star") >= 0, F.get(F.array(*[F.lit(int(m)) for m in merged]), F.col("star"))).otherwise(-1)
    placed = placed.withColumn("solid", solid)

    # Cells are far smaller than blocks. Neighbouring cells of one solid group form a bundle, and bundles meet: a row is
    # copied once for each block in reach, not for each cell.
    reach = cut(_reach(placed), "reach")
    open_cells = _open_cells(reach, reach, metric, eps)
    groups = _bundles(placed, _rank(sample, metric), block_rows, "solid")
    other = groups.select("part", F.col("cell").alias("other"), F.col("solid").alias("osolid"),
                          F.col("bundle").alias("obundle"), F.col("k").alias("ok"))
    met = cut(groups.join(open_cells, "cell").join(other, ["part", "other"])
              .where((F.col("solid") < 0) | (F.col("solid") != F.col("osolid")))
              .select("part", "bundle", "obundle", "ok").distinct(), "met")
    near = _cells(points, sample, metric, eps, categories, connect).withColumn("solid", solid).select(*columns, "cell", "solid")
    near = _with_meets(near, sample, reach, groups, metric, eps)
    rows = (_sent_to(near, groups, met, ["solid"])
            .withColumn("__b", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
            .withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("ok") - 1))))
    mine, theirs = F.concat_ws("#", "bundle", "__b"), F.concat_ws("#", "obundle", "__o")
    rows = rows.select(*columns, F.concat_ws("~", "part", F.least(mine, theirs), F.greatest(mine, theirs)).alias("tile"),
                       F.when(mine == theirs, BOTH).when(mine < theirs, LEFT).otherwise(RIGHT).alias("side"))
    if not connect:
        return rows, None
    names = F.array(*[F.lit(i) for i in anchor_ids])
    links = placed.where("solid >= 0").select(F.col("id").alias("node"), F.get(names, F.col("solid")).alias("root"))
    return rows, links.where("node <> root")


def place_across(left: DataFrame, right: DataFrame, metric: Metric, eps: float, categories: CategoryPairs,
                 block_rows: int | None = None, anchor_blocks: int = ANCHOR_BLOCKS) -> DataFrame:
    """Tiles in which every left point meets every right point of its part within ``eps``.

    In a part of few blocks every left block meets every right block, so few left points cost one copy of the right
    ones. In a larger one only blocks with cells in reach of each other meet: right points that no left point is
    near are not copied at all.
    """
    rows = [cut(side.groupBy("part").agg(F.count(F.lit(1)).alias(name)), "sizes") for side, name in ((left, "kl"), (right, "kr"))]
    block_rows = block_rows or block_size(right, metric, rows[1].agg(F.max("kr")).first()[0] or 0, categories.blocks(16))
    sizes = cut(rows[0].join(rows[1], "part").select("part", *[F.ceil(F.col(k) / block_rows).cast("int").alias(k) for k in ("kl", "kr")]), "blocks")
    parts, blocks, most = sizes.agg(F.count(F.lit(1)), F.sum(F.col("kl") + F.col("kr")), F.max(F.greatest("kl", "kr"))).first()
    bins = max(1, parts // 64)
    large = F.greatest("kl", "kr") > anchor_blocks

    def dealt(side: DataFrame, own: str, other: str, flag: int) -> DataFrame:
        rows = side.join(_small(sizes.where(~large)), "part").withColumn("__b", F.pmod(F.xxhash64("id"), F.col(own)))
        rows = rows.withColumn("__o", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        pair = ["__b", "__o"] if flag == LEFT else ["__o", "__b"]
        small = F.concat(F.lit("p"), F.pmod(F.xxhash64("part"), F.lit(bins)))
        tile = F.when((F.col("kl") == 1) & (F.col("kr") == 1), small).otherwise(F.concat_ws(":", F.lit("b"), "part", *pair))
        return rows.select(*side.columns, tile.alias("tile"), F.lit(flag).alias("side"))

    near = dealt(left, "kl", "kr", LEFT).unionByName(dealt(right, "kr", "kl", RIGHT), allowMissingColumns=True)
    if (most or 0) <= anchor_blocks:
        return near
    names = _small(sizes.where(large).select("part"))
    sides = [side.join(names, "part", "left_semi") for side in (left, right)]
    far = _across_by_anchors(*sides, metric, eps, categories, block_rows, min(MANY_ANCHORS, max(FEW_ANCHORS, 4 * blocks)))
    return near.unionByName(far, allowMissingColumns=True)


def _across_by_anchors(left: DataFrame, right: DataFrame, metric: Metric, eps: float, categories: CategoryPairs,
                       block_rows: int, anchors: int) -> DataFrame:
    """Both sides go to the cells of one set of anchors. Neighbouring cells of a side form bundles of about a block, a
    crowded cell is cut into blocks, and bundles meet if any of their cells are in reach of each other."""
    sample = _anchors(right, metric, anchors)
    rank = _rank(sample, metric)
    cells = [_cells(side, sample, metric, eps, categories, connect=False, marks=True) for side in (left, right)]
    bundles = [_bundles(placed, rank, block_rows) for placed in cells]
    lefts, rights = (b.select("part", "cell", F.col("bundle").alias(name), F.col("k").alias(f"{name}_k"))
                     for b, name in zip(bundles, ("lb", "rb")))
    reach = [cut(_reach(placed), "reach") for placed in cells]
    met = cut(lefts.join(_open_cells(*reach, metric, eps), "cell")
              .join(rights.withColumnRenamed("cell", "other"), ["part", "other"]).select("part", "lb", "lb_k", "rb", "rb_k").distinct(), "met")

    def dealt(side: DataFrame, at: int, own: str, other: str, flag: int) -> DataFrame:
        partners = met.select("part", F.col(own).alias("bundle"), F.col(other).alias("obundle"), F.col(f"{other}_k").alias("ok"))
        near = _cells(side, sample, metric, eps, categories, connect=False).drop("star")
        near = _with_meets(near, sample, reach[1 - at], bundles[1 - at], metric, eps)
        rows = _sent_to(near, bundles[at], partners, [])
        rows = rows.withColumn("__b", F.pmod(F.xxhash64("id"), F.col("k")))
        rows = rows.withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("ok") - 1)))
        mine, theirs = F.concat_ws("#", "bundle", "__b"), F.concat_ws("#", "obundle", "__o")
        tile = F.concat_ws(":", F.lit("a"), "part", *((mine, theirs) if flag == LEFT else (theirs, mine)))
        return rows.select(*side.columns, tile.alias("tile"), F.lit(flag).alias("side"))

    return dealt(left, 0, "lb", "rb", LEFT).unionByName(dealt(right, 1, "rb", "lb", RIGHT), allowMissingColumns=True)


def nearby_order(x: np.ndarray) -> np.ndarray:
    """Row numbers such that neighbours in the order are close: halves along the widest direction, again and again."""
    def halves(at: np.ndarray) -> np.ndarray:
        if len(at) <= 2:
            return at
        y = x[at] - x[at].mean(axis=0)
        along = y @ np.linalg.eigh(y.T @ y)[1][:, -1]
        at = at[np.argsort(along, kind="stable")]
        return np.concatenate([halves(at[:len(at) // 2]), halves(at[len(at) // 2:])])

    return halves(np.arange(len(x)))


# -- inside a tile -----------------------------------------------------------------------------

def _blocks(table: pa.Table, metric: Metric, ordered: bool = False) -> Iterator[tuple[str, Block, Block, bool, pa.Table, pa.Table]]:
    """The pair of blocks of each part of a tile; a part of one block meets itself."""
    parts = sorted(pc.unique(table.column("part")).to_pylist())
    for part in parts:
        rows = table if len(parts) == 1 else table.filter(pc.equal(table.column("part"), part))
        rows = rows.sort_by("id") if ordered else rows
        side = rows.column("side")
        if pc.all(pc.equal(side, BOTH)).as_py():
            block = Block(rows, metric.columns)
            yield part, block, block, True, rows, rows
        else:
            left, right = rows.filter(pc.equal(side, LEFT)), rows.filter(pc.equal(side, RIGHT))
            yield part, Block(left, metric.columns), Block(right, metric.columns), False, left, right


def eps_edges(points: DataFrame, metric: Metric, eps: float, categories: CategoryPairs,
              distance: Callable[[Column, Column], Column] | None = None, **sizes) -> DataFrame:
    """Every pair at distance ≤ eps: ``(part, src, dst, distance)`` with ``src < dst``.

    ``distance`` replaces the metric by the caller's own Column expression over two point structs;
    the metric then only supplies the necessary condition on its gate vector.
    """
    if distance is not None:
        return _own_distance_edges(points, metric, eps, categories, distance, **sizes)
    tiles = place(points, metric, eps, categories, connect=False, **sizes)

    read = categories.reader()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tile_edges(*read(pa.Table.from_batches(list(batches))), metric, eps)

    copies = ", src_copies long, dst_copies long" if "copies" in points.columns else ""
    return categories.sent(tiles.rows).groupBy("tile").applyInArrow(run, f"part string, src string, dst string, distance double{copies}")


def tile_edges(table: pa.Table, listed: dict, metric: Metric, eps: float) -> Iterator[pa.RecordBatch]:
    """The edges of one tile, at most ``PAIRS`` a batch: besides its points a task holds one strip of a comparison
    (``STRIP_PAIRS`` pairs, about 100 MB), however many edges the tile has. Ends are ordered by the rank of their id.
    Points with ``copies`` hand them to their edges."""
    for part, a, b, same, left, right in _blocks(table, metric):
        ids, rank = np.unique(a.ids if same else np.concatenate([a.ids, b.ids]), return_inverse=True)
        ids, x, y = pa.array(ids, pa.string()), rank[:len(a)], rank if same else rank[len(a):]
        cx, cy = (_copies(left), _copies(right)) if "copies" in table.column_names else (None, None)
        for i, j, d in Meeting(a, b, metric, listed, eps).pairs(eps):
            for s in range(0, len(d), PAIRS):
                at, to = i[s:s + PAIRS], j[s:s + PAIRS]
                u, v = x[at], y[to]
                columns = {"part": pa.repeat(pa.scalar(part, pa.string()), len(u)), "src": ids.take(pa.array(np.minimum(u, v))),
                           "dst": ids.take(pa.array(np.maximum(u, v))), "distance": pa.array(d[s:s + PAIRS])}
                if cx is not None:
                    columns["src_copies"] = pa.array(np.where(u <= v, cx[at], cy[to]), pa.int64())
                    columns["dst_copies"] = pa.array(np.where(u <= v, cy[to], cx[at]), pa.int64())
                yield pa.RecordBatch.from_pydict(columns)


def _own_distance_edges(points, metric, eps, categories, distance, **sizes) -> DataFrame:
    """The tiles that find the pairs also hold their points, and hand both on to the caller's distance: pairs meet their
    points in no join, and nothing that grows with the pairs is shuffled or written."""
    column, weight = metric.gate
    gate = Metric(((column, weight),), 0.0, 0.0, 0.0, False, False)
    tiles = place(points, gate, eps, categories, connect=False, **sizes)
    read = categories.reader()
    names = points.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, listed = read(pa.Table.from_batches(list(batches)))
        for _, a, b, same, left, right in _blocks(table, gate):
            ids, rank = np.unique(a.ids if same else np.concatenate([a.ids, b.ids]), return_inverse=True)
            x, y = rank[:len(a)], rank if same else rank[len(a):]
            one, two = (pa.StructArray.from_arrays([_joined(t.column(c)) for c in names], names) for t in (left, right))
            for i, j, _ in within(a, b, gate, listed, eps, half=same):
                first = x[i] <= y[j]
                for u, v, us, vs in ((i[first], j[first], one, two), (j[~first], i[~first], two, one)):
                    order = np.argsort(u, kind="stable")
                    u, v = u[order], v[order]
                    for s in range(0, len(u), OWN_PAIRS):
                        at, to = u[s:s + OWN_PAIRS], v[s:s + OWN_PAIRS]
                        heads = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
                        met = pa.ListArray.from_arrays(pa.array(np.append(heads, len(at)), pa.int32()), vs.take(pa.array(to)))
                        yield pa.RecordBatch.from_arrays([us.take(pa.array(at[heads])), met], ["__x", "__ys"])

    row = points.select(F.struct(*[F.col(c) for c in names]).alias("r")).schema["r"].dataType.simpleString()
    found = categories.sent(tiles.rows).groupBy("tile").applyInArrow(run, f"__x {row}, __ys array<{row}>")
    found = found.select("__x.part", "__x", F.explode("__ys").alias("__y")).select("part", F.col("__x.id").alias("src"), F.col("__y.id").alias("dst"), "__x", "__y")

    def measured(pairs: DataFrame) -> DataFrame:
        return (pairs.withColumn("distance", F.round(distance(F.col("__x"), F.col("__y")), DIGITS))
                .where(F.col("distance") <= eps).select("part", "src", "dst", "distance"))

    # an id that several points share stands for each of them
    shared = cut(points.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "shared-ids")
    if is_empty(shared):
        return measured(found)
    src, dst = (shared.withColumnRenamed("id", end) for end in ("src", "dst"))
    once = found.join(src, "src", "left_anti").join(dst, "dst", "left_anti")
    pairs = eps_edges(points, gate, eps, categories, **sizes).select("part", "src", "dst")
    again = pairs.join(src, "src", "left_semi").unionByName(pairs.join(src, "src", "left_anti").join(dst, "dst", "left_semi"))
    row = F.struct(*[F.col(c) for c in names])
    again = again.join(points.select(F.col("id").alias("src"), row.alias("__x")), "src").join(points.select(F.col("id").alias("dst"), row.alias("__y")), "dst")
    return measured(once).unionByName(measured(again))


def _joined(column: pa.ChunkedArray) -> pa.Array:
    found = column.combine_chunks()
    return pa.concat_arrays(found.chunks) if isinstance(found, pa.ChunkedArray) else found


def distinct_points(points: DataFrame) -> DataFrame:
    """One row per distinct point: the smallest id and the number of ``copies``. Copies are combined
    before the shuffle, so a point with a third of all rows costs one row per task."""
    keys = [c for c in points.columns if c != "id"]
    return points.groupBy(*keys).agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))


def copy_edges(points: DataFrame, metric: Metric, eps: float, categories: CategoryPairs, **sizes) -> DataFrame:
    """Edges between distinct points with the number of copies at either end: the whole ε-graph
    without its pairs of copies: ``(part, src, dst, distance, src_copies, dst_copies)``."""
    unique = cut(distinct_points(points), "distinct")
    return eps_edges(unique, metric, eps, categories, written=True, **sizes)


def neighbor_counts(points: DataFrame, metric: Metric, eps: float, categories: CategoryPairs, **sizes) -> DataFrame:
    """``(part, id, n)`` as :func:`degrees`, but copies are counted once and then handed their count."""
    unique = cut(distinct_points(points), "distinct")
    counted = unique.join(degrees(unique, metric, eps, categories, written=True, **sizes), ["part", "id"])
    keys = [c for c in points.columns if c != "id"]
    return points.join(counted.select(*keys, "n"), keys).select("part", "id", "n")


def degrees(points: DataFrame, metric: Metric, eps: float, categories: CategoryPairs, **sizes) -> DataFrame:
    """``(part, id, n)``: neighbours within eps of every point, itself included; a column ``copies``
    tells how often each point counts. One row per point leaves each tile, never one per pair."""
    tiles = place(points, metric, eps, categories, connect=False, **sizes)

    read = categories.reader()

    def run(table: pa.Table) -> pa.Table:
        table, listed = read(table)
        out = []
        for part, a, b, same, left, right in _blocks(table, metric):
            x, y = _copies(left), _copies(right)
            n, m = Meeting(a, b, metric, listed, eps).count(eps, x, y)
            if same:
                # the point itself, and its copies if they are within eps of each other
                every = np.arange(len(a))
                terms = category_terms(a, a, metric, listed)
                n = n + np.where(exact(a, a, every, every, metric, terms) <= eps, x, 1)
            sides = [(a.ids, n)] if same else [(a.ids, n), (b.ids, m)]
            for ids, count in sides:
                out.append(pa.table({"part": pa.array([part] * len(ids), pa.string()),
                                     "id": pa.array(ids, pa.string()), "n": pa.array(count.astype(np.int64), pa.int64())}))
        return pa.concat_tables(out) if out else _empty("part", "id", n=pa.int64())

    partial = categories.sent(tiles.rows).groupBy("tile").applyInArrow(run, "part string, id string, n long")
    return partial.groupBy("part", "id").agg(F.sum("n").alias("n"))


def core_points(points: DataFrame, metric: Metric, eps: float, categories: CategoryPairs, k: int,
                block_rows: int | None = None, **sizes) -> DataFrame:
    """``(part, id, core)``: does a point have k neighbours, itself included?

    First every block is compared with itself only. In a dense topic that already proves nearly all
    points core; just the others are then counted against what is in their reach.
    """
    rows = cut(points.groupBy("part").agg(F.count(F.lit(1)).alias("__n")), "sizes")
    alone_rows = block_rows or BLOCK_ROWS
    bins = max(1, math.ceil((rows.agg(F.sum("__n")).first()[0] or 0) / alone_rows))
    blocks = F.ceil(F.col("__n") / alone_rows).cast("int")
    packed = F.concat(F.lit("p"), F.pmod(F.xxhash64("part"), F.lit(bins)))
    own = F.concat_ws(":", F.lit("b"), "part", F.pmod(F.xxhash64("id"), blocks))
    alone = (points.join(_small(rows), "part").withColumn("tile", F.when(blocks == 1, packed).otherwise(own))
             .withColumn("side", F.lit(BOTH)).withColumn("whole", blocks == 1).drop("__n"))

    read = categories.reader()

    def inside(table: pa.Table) -> pa.Table:
        table, listed = read(table)
        out = []
        for part, a, b, _, left, _ in _blocks(table, metric):
            n = 1 + Meeting(a, b, metric, listed, eps).count(eps, np.ones(len(a)), np.ones(len(b)))[0]
            out.append(pa.table({"part": pa.array([part] * len(a), pa.string()), "id": pa.array(a.ids, pa.string()),
                                 "core": pa.array(n >= k), "known": pa.array((n >= k) | left.column("whole").to_numpy())}))
        return pa.concat_tables(out) if out else _empty("part", "id", core=pa.bool_(), known=pa.bool_())

    first = cut(categories.sent(alone).groupBy("tile").applyInArrow(inside, "part string, id string, core boolean, known boolean"), "core-first")
    doubtful = points.join(first.where("not known").select("id"), "id", "left_semi")

    counted = _counted(doubtful, points, metric, eps, categories, k, block_rows=block_rows, **sizes)
    return first.where("known").select("part", "id", "core").unionByName(counted)


def _counted(doubtful: DataFrame, points: DataFrame, metric: Metric, eps: float, categories: CategoryPairs, k: int, **sizes) -> DataFrame:
    """``(part, id, core)`` of some of the points, counted against all."""
    read = categories.reader()

    def across(table: pa.Table) -> pa.Table:
        table, listed = read(table)
        out = []
        for part, a, b, _, _, _ in _blocks(table, metric):
            meet = Meeting(a, b, metric, listed, eps)
            n = meet.count(eps, np.ones(len(a)), np.ones(len(b)))[0]
            # the point itself is among the right ones
            i, j = _same_ids(a, b)
            if len(i):
                n -= np.bincount(i[exact(a, b, i, j, metric, meet.terms) <= eps], minlength=len(a))
            out.append(pa.table({"part": pa.array([part] * len(a), pa.string()), "id": pa.array(a.ids, pa.string()),
                                 "n": pa.array(n.astype(np.int64), pa.int64())}))
        return pa.concat_tables(out) if out else _empty("part", "id", n=pa.int64())

    tiles = categories.sent(place_across(doubtful, points, metric, eps, categories, **sizes))
    return (tiles.groupBy("tile").applyInArrow(across, "part string, id string, n long")
            .groupBy("part", "id").agg((F.sum("n") + 1 >= k).alias("core")))


def _same_ids(a: Block, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the two blocks with one id."""
    code = pa.array(np.concatenate([a.ids, b.ids]), pa.string()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    x, y = code[:len(a)], code[len(a):]
    order = np.argsort(y, kind="stable")
    low, high = (np.searchsorted(y[order], x, side) for side in ("left", "right"))
    n = high - low
    return np.repeat(np.arange(len(x)), n), order[np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)]


def flagged_points(points: DataFrame, metric: Metric, eps: float, categories: CategoryPairs, k: int, **sizes) -> tuple[DataFrame, DataFrame]:
    """The core points and the others of a table with a part of many blocks, see :func:`core_points`: points are first compared with
    those read along with them, and written once with what that proves; only the doubtful ones are shuffled and written again."""
    shared = categories.shared

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                table = pa.Table.from_batches([batch.slice(start, BLOCK_ROWS)])
                core = np.zeros(table.num_rows, dtype=bool)
                parts = np.asarray(table.column("part").to_pylist(), dtype=object)
                for part in set(parts):
                    at = np.nonzero(parts == part)[0]
                    a = Block(table.take(pa.array(at)), metric.columns)
                    core[at] = 1 + Meeting(a, a, metric, shared.value, eps).count(eps, np.ones(len(a)), np.ones(len(a)))[0] >= k
                yield from table.append_column("core", pa.array(core)).to_batches()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema.fields)
    first = cut(points.mapInArrow(inside, f"{fields}, core boolean"), "flagged")
    doubtful = first.where("not core").drop("core")
    counted = _counted(doubtful, first.drop("core"), metric, eps, categories, k, **sizes)
    settled = cut(doubtful.join(counted, ["part", "id"], "left").select(*points.columns, F.coalesce("core", F.lit(False)).alias("core")), "settled")
    return first.where("core").drop("core").unionByName(settled.where("core").drop("core")), settled.where("not core").drop("core")


def core_neighbours(points: DataFrame, core: DataFrame, metric: Metric, eps: float, categories: CategoryPairs, **sizes) -> DataFrame:
    """``(part, id, core)``: the core points within eps of each point. A point that is not core has few neighbours, so these
    pairs are few, and no vector has to be sent along with its root."""
    read = categories.reader()

    def run(table: pa.Table) -> pa.Table:
        table, listed = read(table)
        out = []
        for part, a, b, _, _, _ in _blocks(table, metric):
            for i, j, _ in Meeting(a, b, metric, listed, eps).pairs(eps):
                out.append(pa.table({"part": pa.array([part] * len(i), pa.string()), "id": pa.array(a.ids[i], pa.string()), "core": pa.array(b.ids[j], pa.string())}))
        return pa.concat_tables(out) if out else _empty("part", "id", "core")

    tiles = categories.sent(place_across(points, core, metric, eps, categories, **sizes))
    return tiles.groupBy("tile").applyInArrow(run, "part string, id string, core string")


def smallest_roots(points: DataFrame, rooted: DataFrame, metric: Metric, eps: float, categories: CategoryPairs,
                   **sizes) -> DataFrame:
    """``(part, id, root)``: the smallest ``root`` among the ``rooted`` points within eps of each
    point. One row per point and tile leaves a task."""
    read = categories.reader()

    def run(table: pa.Table) -> pa.Table:
        table, listed = read(table)
        out = []
        for part, a, b, _, _, right in _blocks(table, metric):
            names, code = np.unique(np.asarray(right.column("root").to_pylist(), dtype=object), return_inverse=True)
            best = Meeting(a, b, metric, listed, eps).smallest(eps, code, len(names))
            hit = np.nonzero(best < len(names))[0]
            out.append(pa.table({"part": pa.array([part] * len(hit), pa.string()), "id": pa.array(a.ids[hit], pa.string()),
                                 "root": pa.array(names[best[hit]], pa.string())}))
        return pa.concat_tables(out) if out else _empty("part", "id", "root")

    found = categories.sent(place_across(points, rooted, metric, eps, categories, **sizes)).groupBy("tile").applyInArrow(run, "part string, id string, root string")
    return found.groupBy("part", "id").agg(F.min("root").alias("root"))


def links(points: DataFrame, metric: Metric, eps: float, categories: CategoryPairs, **sizes) -> tuple[DataFrame, bool]:
    """Links with the same connected components as the ε-graph: ``(node, root)``. The flag tells that
    no component spans two tiles, so every ``root`` is final."""
    tiles = place(points, metric, eps, categories, connect=True, **sizes)

    read = categories.reader()

    def run(table: pa.Table) -> pa.Table:
        table, listed = read(table)
        out = []
        for _, a, b, same, _, _ in _blocks(table, metric):
            ids = a.ids if same else np.concatenate([a.ids, b.ids])
            order = np.argsort(ids, kind="stable")
            rank = np.empty(len(ids), dtype=np.int64)
            rank[order] = np.arange(len(ids))
            shift = 0 if same else len(a)
            label = np.arange(len(ids))
            Meeting(a, b, metric, listed, eps).connect(eps, label, rank[:len(a)], rank[shift:])
            moved = np.nonzero(label != np.arange(len(ids)))[0]
            names = ids[order]
            out.append(pa.table({"node": pa.array(names[moved], pa.string()), "root": pa.array(names[label[moved]], pa.string())}))
        return pa.concat_tables(out) if out else _empty("node", "root")

    found = categories.sent(tiles.rows).groupBy("tile").applyInArrow(run, "node string, root string")
    if tiles.links is not None:
        found = found.unionByName(tiles.links)
    return found, tiles.single


def _copies(table: pa.Table) -> np.ndarray:
    return table.column("copies").to_numpy() if "copies" in table.column_names else np.ones(table.num_rows)


def _empty(*texts: str, **others: pa.DataType) -> pa.Table:
    columns = {t: pa.array([], pa.string()) for t in texts}
    columns.update({name: pa.array([], kind) for name, kind in others.items()})
    return pa.table(columns)
