"""Category distances inside tasks, for vocabularies of any size."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, prepare, rows_within
from .kernel import category_table, listed_pairs

#: A table of at most this many listed pairs is broadcast whole (16 bytes a pair).
SHARED_PAIRS = 2_000_000
#: Of a table of at most this many pairs a tile is sent its names with all their partners (about 24 bytes a pair), which
#: needs no join of pairs; the task keeps those among its own names.
LISTED_PAIRS, LISTED_BLOCKS = 16_000_000, 5
#: ``side`` of the rows that bring a tile its category distances.
PAIRS = 3


@dataclass
class CategoryPairs:
    """The category distances of a job, in the form its tasks read them.

    A small table is broadcast. Of a larger one each tile is sent the pairs whose names occur among its points, as
    further rows of the tile: one row per name, with the partners in ``cats`` and the distances in ``shares``. Up to
    ``LISTED_PAIRS`` these rows are written once, with all ``partners`` of a name; beyond it a tile gets only pairs whose
    two names both occur in it. A task then holds the vocabulary of its own points, never that of the table.
    """

    shared: Broadcast | None
    table: DataFrame
    partners: DataFrame | None = None

    def blocks(self, wanted: int) -> int:
        """Blocks of a table: every tile that is sent whole partner lists costs as much as the list of all pairs, so
        there are few."""
        return wanted if self.partners is None else min(wanted, LISTED_BLOCKS)

    def sent(self, tiles: DataFrame) -> DataFrame:
        """Rows keyed by ``tile`` and ``side``, with what their tasks need of the table."""
        if self.shared is not None:
            return tiles
        tiles = cut(tiles, "tiles")
        names = tiles.select("tile", F.explode("cats").alias("name")).distinct()
        first, second = names.withColumnRenamed("name", "first_category"), names.withColumnRenamed("name", "second_category")
        if self.partners is not None:
            extra = first.join(self.partners.hint("merge"), "first_category")
        else:
            found = first.join(second, "tile").where("first_category <= second_category").join(self.table, ["first_category", "second_category"])
            extra = _partners(found, "tile")
        extra = extra.select("tile", F.lit(PAIRS).alias("side"), F.lit("").alias("part"), "cats", "shares")
        return tiles.unionByName(extra, allowMissingColumns=True)

    def reader(self) -> Callable[[pa.Table], tuple[pa.Table, dict]]:
        """Splits the rows of a tile into its points and its category distances."""
        shared = self.shared
        if shared is not None:
            return lambda table: (table, shared.value)

        def split(table: pa.Table) -> tuple[pa.Table, dict]:
            extra = pc.equal(table.column("side"), PAIRS)
            points = table.filter(pc.invert(extra))
            names = sorted(pc.unique(points.column("cats").combine_chunks().flatten()).drop_null().to_pylist())
            return points, _read_pairs(table.filter(extra), names)

        return split


def _partners(pairs: DataFrame, *keys: str) -> DataFrame:
    """One row per first name (and ``keys``): the name and its partners in ``cats``, the distances in ``shares``."""
    partners = F.array_sort(F.collect_list(F.struct("second_category", "distance"))).alias("p")
    return pairs.groupBy(*keys, "first_category").agg(partners).select(
        *keys, "first_category", F.concat(F.array("first_category"), F.col("p.second_category")).alias("cats"), F.col("p.distance").alias("shares"))


def _read_pairs(rows: pa.Table, names: list[str]) -> dict:
    """The category distances among ``names`` from rows of partners."""
    known, found = pa.array(names, pa.string()), []
    for batch in rows.select(["cats", "shares"]).to_batches():
        if not batch.num_rows:
            continue
        size = batch.column(0).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        code = pc.index_in(batch.column(0).flatten(), value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        heads = np.cumsum(size) - size
        second = np.delete(code, heads)
        first = np.repeat(code[heads], size - 1)
        keep = (first >= 0) & (second >= 0)
        found.append((first[keep], second[keep], batch.column(1).flatten().to_numpy(zero_copy_only=False)[keep]))
    if not found:
        return category_table([], [], [])
    return listed_pairs(names, *(np.concatenate(c) for c in zip(*found)))


def share_categories(table: DataFrame, shared_pairs: int | None = None) -> CategoryPairs:
    """The category distances of a table of any size: each pair of names in sorted order, with its smallest distance.

    An empty table raises, as no distance would be defined. Rows without a distance list nothing. A table of more
    than ``shared_pairs`` pairs is sent to the tiles instead of being broadcast.
    """
    prepare(table.sparkSession)
    low, high = F.least("first_category", "second_category"), F.greatest("first_category", "second_category")
    pairs = (table.where(F.col("distance").isNotNull() & ~F.isnan("distance")).groupBy(low.alias("first_category"), high.alias("second_category"))
             .agg(F.min("distance").cast("double").alias("distance")))
    pairs = cut(pairs, "category-pairs")
    few = rows_within(pairs, SHARED_PAIRS if shared_pairs is None else shared_pairs)
    if few == 0:
        raise ValueError("the category distance table is empty")
    if few is None:
        if pairs.count() > LISTED_PAIRS:
            return CategoryPairs(None, pairs)
        return CategoryPairs(None, pairs, cut(_partners(pairs), "category-partners"))
    rows = pairs.toPandas()
    listed = category_table(rows.first_category.tolist(), rows.second_category.tolist(), rows.distance.tolist())
    return CategoryPairs(table.sparkSession.sparkContext.broadcast(listed), pairs)
