"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, is_empty

#: Rounds whose vertex moves are joined in one plan before the result is written.
MOVES = 4


def connected_components(links: DataFrame) -> DataFrame:
    """``(u, v)`` links to ``(id, root)``, where root is the smallest id of the component.

    Each round points every vertex at its best neighbour (or itself), then at the best pointer among
    its neighbours, and replaces the links by links between those vertices. The second hop lets all
    leaves of a hub meet in one round. "Best" is the smallest id in the first round, which settles
    star-shaped links at once, and a new random order in later rounds, so that a constant share of
    the vertices disappears even on long chains. Neighbours are reduced with ``min``, which combines
    before the shuffle: a hub with a third of all links is never gathered in one place. Round tables
    are written, not kept as lineage.
    """
    links = links.where("u <> v").select("u", "v")
    moves: list[DataFrame] = []
    done, rounds = None, 0
    while True:
        def rank(vertex: str) -> Column:
            return F.struct(F.xxhash64(F.col(vertex), F.lit(rounds)) if rounds else F.lit(0), F.col(vertex).alias("x"))
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = (both.groupBy("u").agg(F.min(rank("v")).alias("m"))
               .select("u", F.least("m", rank("u"))["x"].alias("p")))
        far = (both.join(low.select(F.col("u").alias("v"), "p"), "v").groupBy("u").agg(F.min(rank("p")).alias("m"))
               .select("u", F.col("m.x").alias("p")))
        up = low.select(F.col("u").alias("p"), F.col("p").alias("q"))
        step = cut(far.join(up, "p").select("u", F.col("q").alias("p")), "cc-step")
        moves.append(step)
        links = cut(links.join(step, "u").select(F.col("p").alias("u"), "v")
                    .join(step.select(F.col("u").alias("v"), F.col("p").alias("q")), "v")
                    .select("u", F.col("q").alias("v")).where("u <> v")
                    .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "cc-links")
        rounds += 1
        last = is_empty(links)
        if last or len(moves) == MOVES:
            done = _moved(done, moves)
            moves = []
            if last:
                break
            done = cut(done, "cc-roots")
    if rounds == 1:
        return done
    smallest = done.groupBy("root").agg(F.min("id").alias("__s"))
    return done.join(smallest, "root").select("id", F.col("__s").alias("root"))


def _moved(done: DataFrame | None, moves: list[DataFrame]) -> DataFrame:
    """Follow the moves; a vertex that no longer appears has reached its root."""
    if done is None:
        done, moves = moves[0].select(F.col("u").alias("id"), F.col("p").alias("root")), moves[1:]
    for step in moves:
        done = (done.join(step.select(F.col("u").alias("root"), F.col("p").alias("__p")), "root", "left")
                .select("id", F.coalesce("__p", "root").alias("root")))
    return done
