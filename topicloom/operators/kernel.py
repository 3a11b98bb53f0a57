"""Vectorised distance checks between two bounded blocks of points.

This is the inside of one Spark task: Spark decides which blocks meet, this module compares
them. Points are Arrow tables with an ``id``, the vector columns of a metric and the lists
``cats`` / ``shares``.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa

from ..settings import DIGITS, Metric

#: Rows of the left block and pairs handled per matrix product at most, and pairs per exact evaluation.
STRIP, STRIP_PAIRS = 512, 1 << 20
PAIRS = 65_536
#: Numbers a table of all category terms may take; beyond it terms are added up pair by pair, if lists are short.
DENSE_TERMS, SHORT_LISTS = 8_000_000, 64


def category_table(first: list[str], second: list[str], distance: list[float]) -> dict:
    """Category distances for tasks: a name index and the listed pairs as sorted codes. Plain values, so that executors
    need nothing but numpy to read a broadcast."""
    names = sorted({*first, *second})
    index = {n: i for i, n in enumerate(names)}
    x, y = (np.fromiter((index[n] for n in ends), np.int64, len(ends)) for ends in (first, second))
    return listed_pairs(names, x, y, distance)


def listed_pairs(names: list[str], first: np.ndarray, second: np.ndarray, distance) -> dict:
    """The same from numbers of the sorted ``names``."""
    codes = np.minimum(first, second) * len(names) + np.maximum(first, second)
    order = np.argsort(codes, kind="stable")
    return {"index": {n: i for i, n in enumerate(names)}, "codes": codes[order], "distances": np.asarray(distance, dtype=float)[order]}


def listed(categories: dict, left: list[str], right: list[str], missing: float) -> np.ndarray:
    """Distances between two name lists, ``missing`` where the table has none."""
    index, codes = categories["index"], categories["codes"]
    rows, cols = (np.array([index.get(n, -1) for n in names], dtype=np.int64) for names in (left, right))
    if len(rows) * len(cols) > max(len(codes), PAIRS):
        # most pairs of the table are wanted, so each is put in its place instead of being searched
        found = np.full((len(rows), len(cols)), missing)
        at, to = (np.full(len(index), -1, np.int64) for _ in range(2))
        at[rows[rows >= 0]], to[cols[cols >= 0]] = np.nonzero(rows >= 0)[0], np.nonzero(cols >= 0)[0]
        one, two = np.divmod(codes, len(index)) if len(codes) else (codes, codes)
        for x, y in ((at[one], to[two]), (at[two], to[one])):
            both = (x >= 0) & (y >= 0)
            found[x[both], y[both]] = categories["distances"][both]
        return found
    low, high = np.minimum.outer(rows, cols), np.maximum.outer(rows, cols)
    if not len(codes) or not low.size:
        return np.full(low.shape, missing)
    wanted = low * len(index) + high
    place = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return np.where((low >= 0) & (codes[place] == wanted), categories["distances"][place], missing)


def vectors(table: pa.Table, column: str) -> np.ndarray:
    data = table.column(column).combine_chunks()
    if isinstance(data, pa.ChunkedArray):
        data = pa.concat_arrays(data.chunks) if data.num_chunks else pa.array([], data.type)
    sizes = data.value_lengths()
    if data.null_count or len(data) and len(sizes.unique()) > 1:
        raise ValueError(f"{column}: vectors must not be null and must have one length")
    flat = data.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(data), -1) if len(data) else np.zeros((0, 1))


def signatures(cats: pa.ChunkedArray, shares: pa.ChunkedArray) -> tuple[np.ndarray, tuple[list[list], list[list]]]:
    """The number of each row's pair of lists, and the distinct pairs. Rows of one length are told apart as rows of a
    matrix of name numbers and shares, so only distinct pairs become Python lists."""
    if cats.null_count or shares.null_count:
        raise ValueError("cats and shares must not be null")
    size = cats.combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    if not np.array_equal(size, shares.combine_chunks().value_lengths().to_numpy(zero_copy_only=False)):
        raise ValueError("cats and shares must have one length")
    sig, first = np.zeros(len(size), dtype=np.int64), []
    names = pa.concat_arrays([c.flatten() for c in cats.chunks] or [pa.array([], pa.string())]).dictionary_encode().indices
    codes = names.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = pa.concat_arrays([c.flatten() for c in shares.chunks] or [pa.array([], pa.float64())])
    parts = parts.to_numpy(zero_copy_only=False).astype(float).view(np.int64)
    start = np.cumsum(size) - size
    for n in np.unique(size).tolist():
        rows = np.nonzero(size == n)[0]
        at = start[rows][:, None] + np.arange(n)
        _, one, own = np.unique(np.hstack([codes[at], parts[at]]), axis=0, return_index=True, return_inverse=True) if n else (None, [0], 0)
        sig[rows] = len(first) + np.reshape(own, -1)
        first += rows[one].tolist()
    take = pa.array(first, pa.int64())
    return sig, (cats.take(take).to_pylist(), shares.take(take).to_pylist())


class Block:
    """Points of one task with their category lists reduced to distinct signatures."""

    def __init__(self, table: pa.Table, columns: list[str]):
        self.ids = table.column("id").to_numpy()
        self.vec = {c: vectors(table, c) for c in columns}
        self.sq = {c: np.einsum("ij,ij->i", v, v) for c, v in self.vec.items()}
        self.sig, (cats, shares) = signatures(table.column("cats"), table.column("shares"))
        self.names = sorted({n for c in cats for n in c})
        at = {n: i for i, n in enumerate(self.names)}
        self.bare = np.array([not c for c in cats], dtype=bool)
        #: Name numbers, shares and ones of each signature, filled up with zeros to the longest list.
        longest = max(map(len, cats), default=0)
        self.slots, self.parts, self.ones = (np.zeros((len(cats), longest), kind) for kind in (np.int64, float, float))
        for row, (names, parts) in enumerate(zip(cats, shares)):
            self.slots[row, :len(names)] = [at[n] for n in names]
            self.parts[row, :len(names)] = parts
            self.ones[row, :len(names)] = 1.0

    def by_name(self, values: np.ndarray) -> np.ndarray:
        """The sums of ``values`` (``parts`` or ``ones``) of each signature by name."""
        out = np.zeros((len(self.bare), len(self.names)))
        np.add.at(out, (np.arange(len(out))[:, None], self.slots), values) if out.size else None
        return out

    def __len__(self) -> int:
        return len(self.ids)


class PairTerms:
    """Weighted category terms of the pairs of signatures that are asked for, ``terms[i, j]``: with many signatures and
    names a table of all of them would be far larger than the points."""

    def __init__(self, a: Block, b: Block, metric: Metric, table: np.ndarray):
        self.a, self.b, self.metric, self.table = a, b, metric, table

    def __getitem__(self, at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        i, j = np.broadcast_arrays(*at)
        a, b, metric = self.a, self.b, self.metric
        left, right = (a.parts, b.parts) if metric.use_shares else (a.ones, b.ones)
        terms = np.zeros(i.shape)
        for p in range(a.slots.shape[1]):
            for q in range(b.slots.shape[1]):
                terms += left[i, p] * right[j, q] * self.table[a.slots[i, p], b.slots[j, q]]
        terms[a.bare[i] | b.bare[j]] = metric.empty
        if not metric.cap:
            terms = np.clip(terms, 0.0, 1.0)
        return metric.category * terms


def category_terms(a: Block, b: Block, metric: Metric, categories: dict) -> np.ndarray | PairTerms:
    """Weighted category term for every pair of signatures."""
    table = listed(categories, a.names, b.names, metric.missing)
    n, m = len(a.bare), len(b.bare)
    if n * len(a.names) + m * len(b.names) + n * m > DENSE_TERMS and a.slots.shape[1] * b.slots.shape[1] <= SHORT_LISTS:
        return PairTerms(a, b, metric, table)
    left, right = (a.by_name(a.parts), b.by_name(b.parts)) if metric.use_shares else (a.by_name(a.ones), b.by_name(b.ones))
    terms = left @ table @ right.T
    terms[a.bare, :] = metric.empty
    terms[:, b.bare] = metric.empty
    if not metric.cap:
        terms = np.clip(terms, 0.0, 1.0)
    return metric.category * terms


def exact(a: Block, b: Block, i: np.ndarray, j: np.ndarray, metric: Metric, terms: np.ndarray) -> np.ndarray:
    """Distances of the pairs ``(i, j)`` from coordinate differences, rounded for comparison."""
    total = terms[a.sig[i], b.sig[j]].astype(float)
    for column, weight in metric.vectors:
        x, y = a.vec[column], b.vec[column]
        for s in range(0, len(i), PAIRS):
            part = slice(s, s + PAIRS)
            gap = x[i[part]] - y[j[part]]
            total[part] += weight * np.sqrt(np.einsum("ij,ij->i", gap, gap))
    if metric.cap:
        total = np.clip(total, 0.0, 1.0)
    return np.round(total, DIGITS)


def near(a: Block, b: Block, metric: Metric, categories: dict, bound, half: bool = False):
    """Yield ``(i, j, approximate distance, tolerance, terms)`` of all pairs with distance at most
    ``bound`` (a number, or one per row of ``b``), strip by strip. Distances come from matrix
    products; callers re-evaluate with :func:`exact` wherever digits matter."""
    if not len(a) or not len(b):
        return
    terms = category_terms(a, b, metric, categories)
    scale = max([1.0] + [float(np.sqrt(max(x.sq[c].max(), 0.0))) for x in (a, b) for c in metric.columns])
    slack = 1e-6 * scale
    limit = np.asarray(bound, dtype=float) + slack
    columns = sorted(metric.vectors, key=lambda v: -v[1])
    step = max(1, min(STRIP, STRIP_PAIRS // len(b)))
    for start in range(0, len(a), step):
        rows = slice(start, min(start + step, len(a)))
        total = np.zeros((rows.stop - rows.start, len(b)))
        for column, weight in columns:
            sq = a.sq[column][rows, None] + b.sq[column][None, :] - 2.0 * (a.vec[column][rows] @ b.vec[column].T)
            total += weight * np.sqrt(np.maximum(sq, 0.0))
        i, j = np.nonzero(total <= limit)
        i = i + start
        if half:
            keep = i < j
            i, j = i[keep], j[keep]
        approx = total[i - start, j] + terms[a.sig[i], b.sig[j]]
        if metric.cap:
            approx = np.clip(approx, 0.0, 1.0)
        keep = approx <= (limit if limit.ndim == 0 else limit[j])
        yield i[keep], j[keep], approx[keep], slack, terms


def within(a: Block, b: Block, metric: Metric, categories: dict, eps: float, half: bool = False,
           distances: bool = False):
    """Yield ``(i, j, distance)`` of all pairs at distance ≤ eps. Without ``distances`` only pairs
    close to the threshold are evaluated exactly."""
    for i, j, approx, slack, terms in near(a, b, metric, categories, eps, half):
        doubtful = np.ones(len(i), dtype=bool) if distances else np.abs(approx - eps) <= 2 * slack
        approx[doubtful] = exact(a, b, i[doubtful], j[doubtful], metric, terms)
        keep = approx <= eps
        yield i[keep], j[keep], approx[keep]


def strips(a: Block, b: Block, metric: Metric, categories: dict, rows: int = 16):
    """Yield ``(first row, distances)`` of all of ``a`` against all of ``b``, a few rows at a time."""
    terms = category_terms(a, b, metric, categories)
    for start in range(0, len(a), rows):
        part = slice(start, start + rows)
        total = terms[np.ix_(a.sig[part], b.sig)]
        for column, weight in metric.vectors:
            gap = a.vec[column][part, None, :] - b.vec[column][None, :, :]
            total = total + weight * np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
        yield start, np.round(total, DIGITS)


def nearest(a: Block, b: Block, metric: Metric, categories: dict, k: int, same: bool) -> np.ndarray:
    """Distances from every point of ``a`` to its k nearest of ``b``, ascending (infinite where there are fewer); with
    ``same`` a point is not its own neighbour. Matrix products leave the pairs that may be among them, and only these are
    evaluated by their coordinates."""
    out = np.full((len(a), k), np.inf)
    if not len(a) or not len(b):
        return out
    terms = category_terms(a, b, metric, categories)
    metric = replace(metric, cap=False)
    scale = max([1.0] + [float(np.sqrt(max(x.sq[c].max(), 0.0))) for x in (a, b) for c in metric.columns])
    slack = 1e-6 * scale * sum(w for _, w in metric.vectors)
    step = max(1, min(STRIP, STRIP_PAIRS // len(b)))
    for start in range(0, len(a), step):
        rows = slice(start, min(start + step, len(a)))
        at = np.arange(rows.stop - rows.start)
        total = terms[np.ix_(a.sig[rows], b.sig)]
        for column, weight in metric.vectors:
            sq = a.sq[column][rows, None] + b.sq[column][None, :] - 2.0 * (a.vec[column][rows] @ b.vec[column].T)
            total += weight * np.sqrt(np.maximum(sq, 0.0))
        if same:
            total[at, start + at] = np.inf
        few = min(k, len(b))
        limit = np.partition(total, few - 1, axis=1)[:, few - 1]
        i, j = np.nonzero((total <= limit[:, None] + 2 * slack) & np.isfinite(total))
        d = exact(a, b, i + start, j, metric, terms)
        order = np.lexsort((d, i))
        i, d = i[order], d[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = place < k
        out[i[keep] + start, place[keep]] = d[keep]
    return out


def spanning_tree(cost: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree (u, v, cost) of a symmetric matrix; infinite entries are no edges."""
    n = len(cost)
    best, source = np.full(n, np.inf), np.zeros(n, dtype=np.int64)
    todo = np.ones(n, dtype=bool)
    u, v, w = [], [], []
    at = 0
    for _ in range(n - 1):
        todo[at] = False
        closer = todo & (cost[at] < best)
        best[closer], source[closer] = cost[at][closer], at
        at = int(np.argmin(np.where(todo, best, np.inf)))
        u.append(source[at])
        v.append(at)
        w.append(best[at])
    return np.array(u, dtype=np.int64), np.array(v, dtype=np.int64), np.array(w, dtype=float)


def unite(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Merge the classes of ``u`` and ``v`` in place; every entry ends at its smallest member."""
    while len(u):
        a, b = label[u], label[v]
        open_ = a != b
        if not open_.any():
            return
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label[:] = jumped
