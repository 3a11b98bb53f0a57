"""Density hierarchy (HDBSCAN) inside parts, and its use to split oversized clusters.

Distances, core distances and spanning trees run on the tiles of ``neighbors``; the spanning tree
of a part that covers several tiles is finished with Borůvka rounds over the tiles' own trees; the
hierarchy is built from the tree's edges in weight order, in batches of bounded size.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import noise_id, topic_id
from ..functions.vectors import dot
from ..session import cut, is_empty
from ..settings import OUTLIER_ALPHA, Metric
from .components import connected_components
from .dense import Meeting
from .lookup import CategoryPairs
from .kernel import vectors
from .neighbors import _blocks, _empty, place
from .ordinal import number_keys, number_within
from .points import doc_points
from .profile import oversized, topic_sizes

#: Metric over the reduced content vector (fixed weights).
REDUCED = Metric((("content_vec", 0.7), ("title_vec", 0.2)), 0.1, 1.0, 1.0, True, False)

#: Spanning tree edges of one part handled by one task at a time.
BATCH_EDGES = 500_000
#: Smallest distance whose inverse is taken.
FLOOR = 1e-9


def principal_axes(rows: DataFrame, part: str, vector: str, k: int = 2) -> DataFrame:
    """First ``k`` principal axes per part: ``(part, mean, axes)``.

    Tasks send sums of outer products, so what meets in one place is one d×d matrix per part,
    whatever the number of rows.
    """
    def moments(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            x = vectors(table, vector)
            parts = np.asarray(table.column(part).to_pylist(), dtype=object)
            for p in sorted(set(parts)):
                mine = x[parts == p]
                square = mine.T @ mine
                total = np.concatenate([[len(mine)], mine.sum(axis=0)])
                n = len(square)
                yield pa.record_batch({
                    part: pa.array([p] * (n + 1), pa.string()), "i": pa.array(range(-1, n), pa.int32()),
                    "row": pa.array([total.tolist()] + square.tolist(), pa.list_(pa.float64()))})

    partial = rows.select(part, vector).mapInArrow(moments, f"{part} string, i int, row array<double>")
    summed = partial.groupBy(part, "i").agg(vector_to_array(Summarizer.sum(array_to_vector("row"))).alias("row"))

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by("i")
        rows_ = table.column("row").to_pylist()
        n, mean = rows_[0][0], np.array(rows_[0][1:]) / rows_[0][0]
        cov = np.array(rows_[1:]) / n - np.outer(mean, mean)
        _, found = np.linalg.eigh((cov + cov.T) / 2)
        axes = found[:, ::-1][:, :k].T
        # an axis has no sign of its own: its largest entry is made positive
        axes = axes * np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])[:, None]
        return pa.table({part: table.column(part).slice(0, 1), "mean": pa.array([mean.tolist()]),
                         "axes": pa.array([axes.tolist()])})

    return summed.groupBy(part).applyInArrow(solve, f"{part} string, mean array<double>, axes array<array<double>>")


def reduce_vectors(rows: DataFrame, part: str, vector: str, k: int = 2, name: str = "reduced") -> DataFrame:
    """Replace the n-dimensional vector by its first ``k`` principal coordinates within its part."""
    axes = principal_axes(rows, part, vector, k)
    centred = F.zip_with(F.col(vector), F.col("mean"), lambda x, m: x - m)
    return (rows.join(axes, part).withColumn("__c", centred)
            .withColumn(name, F.transform("axes", lambda axis: dot(axis, F.col("__c")))).drop("mean", "axes", "__c"))


def core_distances(points: DataFrame, metric: Metric, categories: CategoryPairs, k: int, **sizes) -> DataFrame:
    """``(part, id, core)``: distance to the k-th nearest other point of the part (or the farthest
    one, if there are fewer). Each tile sends at most k numbers per point."""
    tiles = place(points, metric, float("inf"), categories, connect=False, **sizes)

    read = categories.reader()

    def run(table: pa.Table) -> pa.Table:
        table, listed = read(table)
        out = []
        for part, a, b, same, _, _ in _blocks(table, metric):
            near = Meeting(a, b, metric, listed).nearest(k)
            for x, found in zip([a] if same else [a, b], near):
                held = np.isfinite(found)
                ends = np.append(0, np.cumsum(held.sum(axis=1))).astype(np.int32)
                out.append(pa.table({"part": pa.array([part] * len(x), pa.string()), "id": pa.array(x.ids, pa.string()),
                                     "near": pa.ListArray.from_arrays(pa.array(ends), pa.array(found[held]))}))
        return pa.concat_tables(out) if out else _empty("part", "id", near=pa.list_(pa.float64()))

    near = categories.sent(tiles.rows).groupBy("tile").applyInArrow(run, "part string, id string, near array<double>")
    best = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k)
    return near.groupBy("part", "id").agg(best.alias("n")).select(
        "part", "id", F.coalesce(F.array_max("n"), F.lit(0.0)).alias("core"))


def spanning_trees(points: DataFrame, metric: Metric, categories: CategoryPairs, **sizes) -> DataFrame:
    """Minimum spanning tree of the mutual reachability graph of every part: ``(part, u, v, w)``.
    ``points`` carry ``core``. A tree of the whole lies inside the union of the tiles' trees."""
    tiles = place(points, metric, float("inf"), categories, connect=False, **sizes)

    read = categories.reader()

    def run(table: pa.Table) -> pa.Table:
        table, listed = read(table)
        out = []
        for part, a, b, same, left, right in _blocks(table, metric):
            ids = a.ids if same else np.concatenate([a.ids, b.ids])
            u, v, w = Meeting(a, b, metric, listed).tree(left.column("core").to_numpy(), right.column("core").to_numpy())
            x, y = ids[u], ids[v]
            out.append(pa.table({"part": pa.array([part] * len(w), pa.string()), "u": pa.array(np.minimum(x, y), pa.string()),
                                 "v": pa.array(np.maximum(x, y), pa.string()), "w": pa.array(w, pa.float64())}))
        return pa.concat_tables(out) if out else _empty("part", "u", "v", w=pa.float64())

    found = cut(categories.sent(tiles.rows).groupBy("tile").applyInArrow(run, "part string, u string, v string, w double"), "tile-trees")
    return found if tiles.single else _boruvka(found)


def _boruvka(edges: DataFrame) -> DataFrame:
    """Each round every component keeps its lightest outgoing edge and the joined ones contract."""
    kept = []
    open_ = edges.withColumn("x", F.col("u")).withColumn("y", F.col("v"))
    while not is_empty(open_):
        ends = open_.select("part", F.col("x").alias("c"), F.struct("w", "u", "v", "x", "y").alias("e")).unionByName(
            open_.select("part", F.col("y").alias("c"), F.struct("w", "u", "v", "x", "y").alias("e")))
        chosen = cut(ends.groupBy("c").agg(F.min(F.struct("e", "part")).alias("m"))
                     .select("m.part", "m.e.*").distinct(), "lightest")
        kept.append(chosen.select("part", "u", "v", "w"))
        root = connected_components(chosen.select(F.col("x").alias("u"), F.col("y").alias("v")))
        open_ = (open_.join(root.select(F.col("id").alias("x"), F.col("root").alias("__x")), "x")
                 .join(root.select(F.col("id").alias("y"), F.col("root").alias("__y")), "y")
                 .where("__x <> __y").select("part", "u", "v", "w", F.col("__x").alias("x"), F.col("__y").alias("y")))
        open_ = cut(open_, "open-edges")
    tree = kept[0]
    for more in kept[1:]:
        tree = tree.unionByName(more)
    return tree


_STATE = "part string, comp string, size long, fall double, best double, node string"
_STEP = f"kind string, {_STATE}, target string, chosen boolean"


def _merge_batch(table: pa.Table, least: int) -> pa.Table:
    """Run one batch of a part's edges through the hierarchy.

    A component of ``least`` or more points is an open cluster: ``fall`` sums the levels (inverse
    distances) at which its points leave it, ``best`` is the stability its descendants reach (NULL
    without any). Edges of equal weight act together. Where they join two or more open clusters,
    these are closed and a new one opens; otherwise the points of the smaller components join the
    open one, or all of them open one once they are enough. A component that is no cluster yet is a
    node that is never chosen. Emits the changed component states, the moves, the closed nodes and
    the points that leave a cluster.
    """
    rows = table.to_pylist()
    part = rows[0]["part"]
    state = {r["comp"]: [r["size"], r["fall"], r["best"], r["node"]] for r in rows if r["kind"] == "comp"}
    edges = sorted((r["fall"], f"{r['node']}|{r['target']}", r["comp"], r["extra"]) for r in rows if r["kind"] == "edge")
    parent: dict[str, str] = {}
    out: list[dict] = []

    def find(c: str) -> str:
        path = []
        while parent.setdefault(c, c) != c:
            path.append(c)
            c = parent[c]
        for p in path:
            parent[p] = c
        return c

    for weight, together in groupby(edges, key=lambda e: e[0]):
        level = 1.0 / max(weight, FLOOR)
        joined: dict[str, tuple[list[str], str]] = {}
        for _, name, x, y in together:
            x, y = find(x), find(y)
            if x == y:
                continue
            few, many = sorted((joined.pop(c, ([c], name)) for c in (x, y)), key=lambda m: len(m[0]))
            many[0].extend(few[0])
            parent[x] = parent[y] = min(x, y)
            joined[min(x, y)] = (many[0], min(few[1], many[1]))
        for z, (members, name) in joined.items():
            met = [(m, state.pop(m)) for m in sorted(members) if m in state]
            singles = [m for m in members if m not in {c for c, _ in met}]
            size = len(singles) + sum(s[0] for _, s in met)
            open_ = [(m, s) for m, s in met if s[0] >= least]
            if len(open_) == 1:
                _, (old, fall, best, node) = open_[0]
                state[z] = [size, fall + (size - old) * level, best, node]
            else:
                best, node = None, name
                for _, (n, fall, below, inner) in open_:
                    stability = fall - n * level
                    chosen = below is None or stability >= below
                    best = (best or 0.0) + (stability if chosen else below)
                    out.append(dict(kind="node", node=inner, target=node, chosen=chosen))
                state[z] = [size, size * level, best, node]
            out += [dict(kind="node", node=s[3], target=node, chosen=False) for _, s in met if s[0] < least]
            out += [dict(kind="point", comp=m, node=node) for m in singles]
    out += [dict(kind="move", comp=c, target=find(c)) for c in list(parent)]
    out += [dict(kind="comp", comp=c, size=s[0], fall=s[1], best=s[2], node=s[3]) for c, s in state.items()]
    schema = pa.schema([("kind", pa.string()), ("part", pa.string()), ("comp", pa.string()), ("size", pa.int64()),
                        ("fall", pa.float64()), ("best", pa.float64()), ("node", pa.string()),
                        ("target", pa.string()), ("chosen", pa.bool_())])
    return pa.Table.from_pylist([dict(o, part=part) for o in out], schema)


def hierarchy_labels(tree: DataFrame, batch_edges: int = BATCH_EDGES, min_cluster_size: int = 2) -> DataFrame:
    """Clusters of at least ``min_cluster_size`` points of a spanning tree by excess of mass:
    ``(part, id, node)`` of clustered points. The part as a whole is never a cluster.

    Copies (distance 0) become one component with joins first, whatever their number. The other
    edges run in weight order, ``batch_edges`` of a part at a time.
    """
    copies = tree.where(F.col("w") <= FLOOR)
    edges = tree.where(F.col("w") > FLOOR)
    biggest = edges.groupBy("part").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if biggest <= batch_edges:
        edges = edges.withColumn("batch", F.lit(0))
    else:
        ranked = number_within(edges.withColumn("key", F.struct("w", "u", "v")), "part", "key", "o").select("part", "key.*", "o")
        first = ranked.groupBy("part", "w").agg(F.min("o").alias("f"))
        edges = ranked.join(first, ["part", "w"]).select("part", "u", "v", "w", F.floor(F.col("f") / batch_edges).cast("int").alias("batch"))
    edges = cut(edges, "edges")

    comps, states, done = None, None, []
    if not is_empty(copies):
        comps = cut(connected_components(copies).select("id", F.col("root").alias("comp"))
                    .join(copies.select(F.explode(F.array("u", "v")).alias("id"), "part").distinct(), "id"), "copies")
        node = F.concat(F.lit("copies|"), F.col("comp")).alias("node")
        n = F.count(F.lit(1))
        states = cut(comps.groupBy("part", "comp").agg(n.alias("size"), (n / FLOOR).alias("fall")).select(
            "part", "comp", "size", "fall", F.lit(None).cast("double").alias("best"), node), "states")
        done.append(comps.select(F.lit("point").alias("kind"), "part", F.col("id").alias("comp"), node,
                                 F.lit(None).cast("string").alias("target"), F.lit(None).cast("boolean").alias("chosen")))
        comps = comps.select("id", "comp")
    batches = -(-biggest // batch_edges)
    for b in range(batches):
        ends = edges.where(F.col("batch") == b).withColumn("x", F.col("u")).withColumn("y", F.col("v"))
        if comps is not None:
            for end, at in (("u", "x"), ("v", "y")):
                ends = (ends.join(comps.select(F.col("id").alias(end), F.col("comp").alias("__c")), end, "left")
                        .withColumn(at, F.coalesce("__c", at)).drop("__c"))
        group = ends.select(F.lit("edge").alias("kind"), "part", F.col("x").alias("comp"), F.lit(None).cast("long").alias("size"),
                            F.col("w").alias("fall"), F.lit(None).cast("double").alias("best"), F.col("u").alias("node"),
                            F.col("v").alias("target"), F.col("y").alias("extra"))
        if states is not None:
            touched = ends.select(F.explode(F.array("x", "y")).alias("comp")).distinct()
            group = group.unionByName(states.join(touched, "comp", "left_semi").withColumn("kind", F.lit("comp")),
                                      allowMissingColumns=True)
        step = cut(group.groupBy("part").applyInArrow(lambda t: _merge_batch(t, min_cluster_size), _STEP), "merge")
        done.append(step.where("kind in ('node', 'point')").select("kind", "part", "comp", "node", "target", "chosen"))
        if b + 1 == batches:
            break
        fresh = step.where("kind = 'comp'").select("part", "comp", "size", "fall", "best", "node")
        moves = step.where("kind = 'move'").select("comp", F.col("target").alias("to"))
        states = fresh if states is None else states.join(moves, "comp", "left_anti").unionByName(fresh)
        states = cut(states, "states")
        known = moves.select(F.col("comp").alias("id"), F.col("to").alias("comp"))
        if comps is not None:
            older = comps.join(moves, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp"))
            known = older.unionByName(known.join(comps, "id", "left_anti"))
        comps = cut(known, "comps")
    if not done:
        return tree.select("part", F.col("u").alias("id"), F.col("v").alias("node")).limit(0)
    events = reduce(DataFrame.unionByName, done)
    top = _topmost(events.where("kind = 'node'").select("node", F.col("target").alias("up"), "chosen"))
    return (events.where("kind = 'point'").select("part", F.col("comp").alias("id"), "node")
            .join(top, "node").select("part", "id", F.col("top").alias("node")))


def _topmost(nodes: DataFrame) -> DataFrame:
    """``(node, top)``: the highest chosen cluster on each node's way up, by pointer doubling."""
    walk = nodes.select("node", "up", F.when(F.col("chosen"), F.col("node")).alias("top"))
    while True:
        walk = cut(walk, "walk")
        above = walk.select(F.col("node").alias("up"), F.col("up").alias("__u"), F.col("top").alias("__t"), F.lit(True).alias("__k"))
        longer = walk.join(above, "up", "left")
        if is_empty(longer.where("__k")):
            return walk.where("top is not null").select("node", "top")
        walk = longer.select("node", F.col("__u").alias("up"), F.coalesce("__t", "top").alias("top"))


def density_hierarchy(points: DataFrame, metric: Metric, categories: CategoryPairs, min_cluster_size: int = 2,
                      batch_edges: int = BATCH_EDGES, **sizes) -> DataFrame:
    """``(part, id, root)`` of points clustered by their density hierarchy inside each part; ``root``
    is the smallest id of the cluster. Clusters have ``min_cluster_size`` points at least, and core
    distances reach that many other points."""
    if min_cluster_size < 2:
        raise ValueError("a cluster has two points at least")
    cores = core_distances(points, metric, categories, min_cluster_size, **sizes)
    ready = cut(points.join(cores, ["part", "id"]), "reachable")
    found = hierarchy_labels(spanning_trees(ready, metric, categories, **sizes), batch_edges, min_cluster_size)
    roots = found.groupBy("part", "node").agg(F.min("id").alias("root"))
    return found.join(roots, ["part", "node"]).select("part", "id", "root")


def split_outliers(docs: DataFrame, categories: CategoryPairs, day: dt.date, n_clusters: int, *,
                   vector: str = "content_embedding", alpha: float = OUTLIER_ALPHA, **sizes) -> DataFrame:
    """``(url, old, new)`` of all documents in clusters whose size is an outlier: the content vector
    is reduced to two dimensions and the cluster is split by its density hierarchy. New clusters are
    numbered from ``n_clusters + 1``, left over documents get the day's noise id."""
    big = oversized(topic_sizes(docs, "cluster"), "cluster", alpha=alpha).select("cluster")
    chosen = cut(docs.join(big, "cluster"), "outliers")
    if is_empty(chosen):
        return chosen.select("url", F.col("cluster").alias("old"), F.col("cluster").alias("new"))
    reduced = reduce_vectors(chosen, "cluster", vector)
    found = density_hierarchy(doc_points(reduced, part="cluster", content="reduced"), REDUCED, categories, **sizes)
    found = cut(found, "hierarchy")
    numbers = number_keys(found, ["part", "root"])
    fresh = (found.join(numbers, ["part", "root"])
             .select(F.col("id").alias("url"), topic_id(F.col("ordinal") + F.lit(n_clusters + 1), F.lit(day)).alias("new")))
    return chosen.select("url", F.col("cluster").alias("old")).join(fresh, "url", "left").select(
        "url", "old", F.coalesce("new", noise_id(F.lit(day))).alias("new"))
