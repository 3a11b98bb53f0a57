"""The density hierarchy against a direct top-down evaluation on small data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicloom.operators.hierarchy import (core_distances, density_hierarchy, principal_axes, reduce_vectors,
                                           spanning_trees)
from topicloom.operators.lookup import share_categories
from topicloom.settings import Metric

PLAIN = Metric((("title_vec", 1.0),), 0.0, 0.0, 0.0, False, False)


def brute_force(ids, x, least=2):
    """Excess of mass by removing edges of the complete reachability graph from the heaviest down."""
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), 9)
    n = len(x)
    core = np.sort(d + np.diag(np.full(n, -1.0)), axis=1)[:, min(least, n - 1)]
    reach = np.maximum(np.maximum(core[:, None], core[None]), d)

    def parts(members, below):
        left, out = set(members), []
        while left:
            todo, seen = [left.pop()], set()
            while todo:
                a = todo.pop()
                seen.add(a)
                near = {b for b in left if reach[a, b] < below}
                left -= near
                todo += near
            out.append(seen)
        return out

    def grow(members, birth):
        """(stability, best selection) of the cluster born at level ``birth``."""
        stability, inside = 0.0, set(members)
        while True:
            # weight at which the cluster first falls apart
            weights = sorted({reach[a, b] for a in inside for b in inside if a != b}, reverse=True)
            for w in weights:
                pieces = parts(inside, w)
                if len(pieces) > 1:
                    break
            level = 1 / max(w, 1e-9)
            big = [p for p in pieces if len(p) >= least]
            if len(big) == 1:
                stability += (len(inside) - len(big[0])) * (level - birth)
                inside = big[0]
                continue
            stability += len(inside) * (level - birth)
            below = [grow(p, level) for p in big]
            break
        if big and sum(b[0] for b in below) > stability:
            return sum(b[0] for b in below), [c for b in below for c in b[1]]
        return stability, [set(members)]

    inside = set(range(n))
    while True:
        weights = sorted({reach[a, b] for a in inside for b in inside if a != b}, reverse=True)
        pieces = [inside]
        for w in weights:
            pieces = parts(inside, w)
            if len(pieces) > 1:
                break
        big = [p for p in pieces if len(p) >= least]
        if len(big) != 1 or len(pieces) == 1:
            break
        inside = big[0]
    if len(pieces) == 1 or not big:
        return set()
    chosen = [c for p in big for c in grow(p, 1 / max(w, 1e-9))[1]]
    return {frozenset(ids[i] for i in c) for c in chosen}


@pytest.fixture(scope="module")
def categories(spark):
    return share_categories(spark.createDataFrame([("a", "b", 0.5)], "first_category string, second_category string, distance double"))


def points(spark, groups):
    rows = [(i, part, v.tolist(), v.tolist(), [], []) for part, ids, x in groups for i, v in zip(ids, x)]
    return spark.createDataFrame(rows, "id string, part string, title_vec array<double>, content_vec array<double>, "
                                       "cats array<string>, shares array<double>").repartition(3)


def clusters(found):
    out = {}
    for r in found.collect():
        out.setdefault((r.part, r.root), set()).add(r.id)
    return {frozenset(v) for v in out.values()}


def data(seed):
    rng = np.random.default_rng(seed)
    groups = []
    for part, n in (("p", 14), ("q", 25), ("r", 3)):
        centers = rng.normal(size=(4, 3)) * 4
        x = centers[rng.integers(0, 4, n)] + rng.normal(size=(n, 3)) * rng.choice([0.3, 1.0], (n, 1))
        if part == "q":
            x[5:9] = x[4]  # copies
        groups.append((part, [f"{part}{i:02d}" for i in range(n)], x))
    return groups


@pytest.mark.parametrize("seed, sizes", [
    (2, dict()), (1, dict(block_rows=5, anchor_blocks=100, batch_edges=10)),
    (2, dict(block_rows=4, anchor_blocks=1, batch_edges=8))])
def test_matches_brute_force(spark, categories, seed, sizes):
    groups = data(seed)
    found = clusters(density_hierarchy(points(spark, groups), PLAIN, categories, **sizes))
    expected = set().union(*[brute_force(ids, x) for _, ids, x in groups])
    assert found == expected


@pytest.mark.parametrize("least", [3, 5])
@pytest.mark.parametrize("seed, sizes", [(1, dict()), (2, dict(batch_edges=6)), (4, dict(block_rows=5, anchor_blocks=100, batch_edges=9))])
def test_larger_clusters_match_brute_force(spark, categories, seed, sizes, least):
    """Components below the size are no clusters, whichever batch they form in; copies are components like any other."""
    groups = data(seed)
    found = clusters(density_hierarchy(points(spark, groups), PLAIN, categories, least, **sizes))
    expected = set().union(*[brute_force(ids, x, least) for _, ids, x in groups])
    assert found == expected and expected and all(len(c) >= least for c in found)


def test_a_cluster_of_one_point_is_refused(spark, categories):
    with pytest.raises(ValueError):
        density_hierarchy(points(spark, data(1)), PLAIN, categories, 1)


def test_spanning_tree_is_minimal_across_tiles(spark, categories):
    pts = points(spark, data(3))
    ready = pts.join(core_distances(pts, PLAIN, categories, 2, block_rows=6), ["part", "id"])
    one = spanning_trees(ready, PLAIN, categories).groupBy("part").agg(F.count("w"), F.round(F.sum("w"), 6))
    many = spanning_trees(ready, PLAIN, categories, block_rows=4).groupBy("part").agg(F.count("w"), F.round(F.sum("w"), 6))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_axes_match_eigenvectors(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5)) * [5, 3, 1, 0.5, 0.1]
    df = spark.createDataFrame([("p", v.tolist()) for v in x], "part string, v array<double>").repartition(4)
    row = principal_axes(df, "part", "v").first()
    _, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    for axis, expected in zip(np.array(row.axes), vectors[:, ::-1].T):
        assert abs(abs(axis @ expected) - 1) < 1e-9 and axis[np.abs(axis).argmax()] > 0
    reduced = np.array([r[0] for r in reduce_vectors(df, "part", "v").select("reduced").collect()])
    assert reduced.shape == (200, 2) and reduced[:, 0].var() > reduced[:, 1].var()


def test_nearest_is_exact():
    import pyarrow as pa

    from topicloom.operators.kernel import Block, category_table, nearest, strips

    rng = np.random.default_rng(3)
    metric = Metric((("title_vec", 0.7), ("content_vec", 0.2)), 0.1, 1.0, 1.0, True, False)
    def block(n):
        x = rng.normal(size=(n, 4))
        x[: n // 3] = x[0]
        return Block(pa.table({"id": [str(i) for i in range(n)], "title_vec": x.tolist(), "content_vec": x[:, ::-1].tolist(),
                               "cats": [["a"], ["b"], ["a", "b"]] * (n // 3), "shares": [[1.0], [1.0], [0.5, 0.5]] * (n // 3)}), metric.columns)
    a, b, listed = block(90), block(60), category_table(["a"], ["b"], [0.3])
    for x, y, same, k in ((a, b, False, 3), (a, a, True, 2), (b, a, False, 200)):
        d = np.concatenate([part for _, part in strips(x, y, metric, listed)])
        if same:
            np.fill_diagonal(d, np.inf)
        want = np.full((len(x), k), np.inf)
        want[:, : min(k, len(y))] = np.sort(d, axis=1)[:, :k]
        assert np.array_equal(nearest(x, y, metric, listed, k, same), want)


def test_meeting_gives_exact_reductions(monkeypatch):
    """Counts, links, smallest roots, nearest points and spanning trees of two blocks against all their distances, in small chunks,
    for copies, far offsets and large vectors."""
    import pyarrow as pa

    from topicloom.operators import dense
    from topicloom.operators.kernel import Block, category_table, spanning_tree, strips, unite

    monkeypatch.setattr(dense, "CHUNK", 16)
    monkeypatch.setattr(dense, "WIDE", 2)
    metric = Metric((("title_vec", 0.8), ("content_vec", 0.1)), 0.1, 1.0, 1.0, True, False)
    listed = category_table(["a", "a"], ["a", "b"], [0.0, 0.4])

    def block(n, seed, scale, offset):
        rng = np.random.default_rng(seed)
        x = np.random.default_rng(9).normal(size=(4, 5))[rng.integers(0, 4, n)] * 2 + rng.normal(size=(n, 5)) * rng.choice([0.05, 0.3], (n, 1))
        x[: n // 5] = x[0]
        x = x * scale + offset
        cats = [[["a"], ["b"], ["a", "b"], []][i % 4] for i in range(n)]
        return Block(pa.table({"id": [str(i) for i in range(n)], "title_vec": x.tolist(), "content_vec": x[:, ::-1].tolist(),
                               "cats": pa.array(cats, pa.list_(pa.string())),
                               "shares": pa.array([[1 / len(c)] * len(c) if c else [] for c in cats], pa.list_(pa.float64()))}), metric.columns)

    for scale, offset in ((1, 0), (1, 1e4), (1e6, 0)):
        a, b, eps = block(110, 1, scale, offset), block(70, 2, scale, offset), 0.5 * scale
        for y in (b, a):
            d = np.concatenate([part for _, part in strips(a, y, metric, listed)])
            same, near, weights = y is a, d <= eps, np.arange(1, len(y) + 1) % 3 + 1
            meet = dense.Meeting(a, y, metric, listed, eps)
            code = np.arange(len(y)) * 7 % 20
            assert np.array_equal(meet.smallest(eps, code, 20), np.where(near, code[None], 20).min(axis=1))
            if same:
                np.fill_diagonal(near, False)
            n, m = meet.count(eps, weights if same else np.ones(len(a)), weights)
            assert np.array_equal(n, near @ weights) and np.array_equal(m, weights @ near if same else near.sum(axis=0))
            nodes, shift = (len(a), 0) if same else (len(a) + len(y), len(a))
            one, two = np.arange(nodes), np.arange(nodes)
            meet.connect(eps, one, np.arange(len(a)), np.arange(len(y)) + shift)
            unite(two, *(np.nonzero(near) + np.array([[0], [shift]])))
            assert np.array_equal(one, two)
            pairs = {(i, j): v for i, j, v in ((i, j, v) for p in meet.pairs(eps) for i, j, v in zip(*p))}
            want = {(i, j) for i, j in zip(*np.nonzero(near))}
            assert {p for q in pairs for p in ((q, q[::-1]) if same else (q,))} == want and len(pairs) == len(want) // (2 if same else 1)
            if same:
                np.fill_diagonal(d, np.inf)
            found = meet.nearest(3)
            assert np.allclose(found[0], np.sort(d, axis=1)[:, :3], rtol=0, atol=2e-9) and np.allclose(found[1], np.sort(d, axis=0)[:3].T, rtol=0, atol=2e-9)
            core_a, core_b = found[0][:, 1], found[1][:, 1]
            reach, cost = np.maximum(np.maximum(core_a[:, None], core_b[None]), d), np.full((nodes, nodes), np.inf)
            cost[:len(a), shift:] = reach
            cost[shift:, :len(a)] = reach.T
            u, v, w = meet.tree(core_a, core_b, known=2)
            label = np.arange(nodes)
            unite(label, u, v)
            assert len(w) == nodes - 1 and not label.any() and np.allclose(cost[u, v], w, rtol=0, atol=2e-9)
            assert np.allclose(np.sort(w), np.sort(spanning_tree(cost)[2]), rtol=0, atol=5e-9)
