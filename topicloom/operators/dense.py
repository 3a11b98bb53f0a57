"""Comparisons of two blocks whose results are reductions over their pairs: counts, links, smallest roots, nearest points
and spanning trees.

Where many pairs lie within the radius, listing them (``kernel.within``) costs far more than comparing them. Here the rows
of a block are put in an order in which near rows stand together, and cut into chunks. Centres and radii of two chunks
tell whether they are too far apart to matter or lie within the radius as a whole; all others are compared by products of
single precision vectors about a common centre. These carry a bound of their error, and a pair that the bound leaves open
is evaluated by its coordinates (``kernel.exact``), so results are those of the exact distances.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np

from ..settings import Metric
from .kernel import PAIRS, Block, category_terms, exact, unite

#: Rows of a chunk, and chunks that are compared with one at once: about a megabyte of single precision numbers.
CHUNK, WIDE = 256, 4
#: Centres that the rows of a block are ordered by, and the rows that they are found from.
CENTRES, SEEN = 32, 1_024
#: Numbers that category terms, spread over the rows of a block, may take.
SPREAD_TERMS = 16_000_000
#: Points that a node of a spanning tree knows at first.
KNOWN = 8


def _closest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sq = np.einsum("ij,ij->i", centres, centres)[None, :] - 2 * x @ centres.T
    own = sq.argmin(axis=1)
    return own, sq[np.arange(len(x)), own] + np.einsum("ij,ij->i", x, x)


def chunk_order(x: np.ndarray) -> np.ndarray:
    """Row numbers by nearest centre and distance from it. Any order gives the same results."""
    if len(x) <= CHUNK:
        return np.arange(len(x))
    with np.errstate(all="ignore"):
        seen = x[:: -(-len(x) // SEEN)]
        centres = seen[:: -(-len(seen) // CENTRES)]
        for _ in range(3):
            own, _ = _closest(seen, centres)
            centres = np.array([seen[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        own, away = _closest(x, centres)
    return np.lexsort((away, own))


class Meeting:
    """Two blocks laid out for comparison; ``a is b`` compares a block with itself. Arrays that methods take and return are in
    the order of the blocks' rows. ``bound`` is the radius of interest, if there is one."""

    def __init__(self, a: Block, b: Block, metric: Metric, categories: dict, bound: float = np.inf):
        self.a, self.b, self.metric, self.same = a, b, metric, a is b
        if not len(a) or not len(b):
            return
        self.terms = category_terms(a, b, metric, categories)
        self.dense = isinstance(self.terms, np.ndarray)
        columns = sorted(metric.vectors, key=lambda v: -v[1])
        self.rows = chunk_order(a.vec[columns[0][0]])
        self.cols = self.rows if self.same else chunk_order(b.vec[columns[0][0]])
        self.row_heads, self.col_heads = (np.arange(0, len(x), CHUNK) for x in (a, b))
        low, high, scale, reach, cancelled = 0.0, 0.0, 0.0, [], 0.0
        centred = []
        with np.errstate(all="ignore"):
            for column, weight in columns:
                x = a.vec[column][self.rows] * weight
                y = x if self.same else b.vec[column][self.cols] * weight
                (cx, rx), (cy, ry) = self._chunks(x, self.row_heads), self._chunks(y, self.col_heads)
                gap = np.array([np.sqrt(((cy - c) ** 2).sum(axis=1)) for c in cx])
                wide = rx[:, None] + ry[None, :]
                low, high = low + np.maximum(gap - wide, 0.0), high + gap + wide
                middle = cx[np.isfinite(cx).all(axis=1)]
                middle = middle.mean(axis=0) if len(middle) else np.zeros(x.shape[1])
                ends = [np.abs(v[np.isfinite(v)]).max(initial=0.0) for v in (x, y)]
                cancelled += np.sqrt(x.shape[1]) * 2.0 ** -50 * max(ends)
                x = x - middle
                y = x if self.same else y - middle
                sq = [np.einsum("ij,ij->i", v, v) for v in (x, y)]
                reach.append(sum(float(np.sqrt(s[np.isfinite(s)].max(initial=0.0))) for s in sq))
                centred.append((x, y, *sq))
                scale = max(scale, *ends)
        self.tiny = 1e-8 * (1.0 + scale)
        self.low, self.high = low, high
        width = [c[0].shape[1] + 8 for c in centred]
        for kind, unit in ((np.float32, 2.0 ** -24), (np.float64, 2.0 ** -53)):
            self.kind = kind
            #: errors of squared distances of each vector, and what all other steps add
            self.errors = [1.2 * w * unit * r * r + 1e-36 for w, r in zip(width, reach)]
            if self.dense:
                most = float(np.abs(self.terms).max(initial=0.0))
            else:
                longest = a.slots.shape[1] * b.slots.shape[1]
                most = metric.category * max(float(np.abs(self.terms.table).max(initial=0.0)) * longest, abs(metric.empty))
            self.rest = 8 * unit * (sum(reach) + most + (bound if np.isfinite(bound) else 0.0)) + cancelled + 1e-9
            self.slack = sum(np.sqrt(self.errors)) + self.rest
            if max(reach, default=0.0) < 1e15 and (not np.isfinite(bound) or self.slack <= 0.05 * abs(bound)):
                break
        self.products = []
        with np.errstate(all="ignore"):
            while centred:
                x, y, sx, sy = centred.pop(0)
                left, right = np.empty((len(x), x.shape[1] + 2), self.kind), np.empty((y.shape[1] + 2, len(y)), self.kind)
                left[:, :-2], left[:, -2], left[:, -1] = x, sx, 1
                right[:-2], right[-2], right[-1] = -2 * y.T, 1, sy
                self.products.append((left, right))
        self.buffers = [np.empty(CHUNK * CHUNK * WIDE, self.kind) for _ in range(len(self.products) + 1)]
        self.row_sig, col_sig = a.sig[self.rows], b.sig[self.cols]
        self.col_sig, self.spread = col_sig, None
        if self.dense:
            terms = self.terms.astype(self.kind)
            self.most_term = float(self.terms.max(initial=0.0))
            self.spread = terms[:, col_sig] if len(terms) * len(b) <= SPREAD_TERMS else None
            self.terms_of_kind = terms

    @staticmethod
    def _chunks(x: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centre and radius of each chunk."""
        size = np.diff(np.append(heads, len(x)))
        centre = np.add.reduceat(x, heads, axis=0) / size[:, None]
        away = x - np.repeat(centre, size, axis=0)
        return centre, np.sqrt(np.maximum.reduceat(np.einsum("ij,ij->i", away, away), heads))

    def _pieces(self, open_: np.ndarray, first: int = 0) -> Iterator[tuple[slice, slice]]:
        """Slices of rows and columns that cover the chunk pairs of ``open_``, whose first row is chunk ``first``."""
        for r in range(len(open_)):
            at = np.flatnonzero(open_[r])
            for run in np.split(at, np.flatnonzero(np.diff(at) != 1) + 1):
                for s in range(0, len(run), WIDE):
                    own, some = r + first, run[s:s + WIDE]
                    yield (slice(own * CHUNK, min((own + 1) * CHUNK, len(self.a))),
                           slice(int(some[0]) * CHUNK, min((int(some[-1]) + 1) * CHUNK, len(self.b))))

    def _compare(self, rows, cols, limit: float | None = None):
        """Approximate distances of rows and columns (slices, or one of them an array) and their vector terms; None if the first
        term alone exceeds ``limit`` everywhere. Terms of sparse categories are left out. Both live until the next call."""
        parts, shape = [], None
        for (left, right), buffer in zip(self.products, self.buffers):
            x, y = left[rows], right[:, cols]
            shape = (len(x), y.shape[1])
            part = buffer[:shape[0] * shape[1]].reshape(shape)
            np.matmul(x, y, out=part)
            np.abs(part, out=part)
            np.sqrt(part, out=part)
            if limit is not None and not parts and not (part <= limit).any():
                return None
            parts.append(part)
        total = self.buffers[-1][:shape[0] * shape[1]].reshape(shape)
        np.add(parts[0], parts[1] if len(parts) > 1 else 0, out=total)
        for part in parts[2:]:
            total += part
        if self.dense:
            if self.spread is not None:
                total += np.take(self.spread[:, cols], self.row_sig[rows], axis=0)
            else:
                total += self.terms_of_kind[np.ix_(self.row_sig[rows], self.col_sig[cols])]
        return total, parts

    def _at(self, rows, cols, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Laid-out row and column numbers of places in a piece."""
        return (i + rows.start if isinstance(rows, slice) else rows[i]), (j + cols.start if isinstance(cols, slice) else cols[j])

    def _open(self, rows, cols, mask: np.ndarray, total: np.ndarray, parts: list[np.ndarray]):
        """Places of ``mask`` with the approximate distance of each and the bound of its error."""
        flat = np.flatnonzero(mask)
        i, j = np.divmod(flat, mask.shape[1])
        value = total.ravel()[flat].astype(float)
        error = np.full(len(flat), self.rest)
        for part, e in zip(parts, self.errors):
            error += np.minimum(np.sqrt(e), e / np.maximum(part.ravel()[flat].astype(float), 1e-18))
        at, to = self._at(rows, cols, i, j)
        if not self.dense:
            for s in range(0, len(flat), PAIRS):
                p = slice(s, s + PAIRS)
                value[p] += self.terms[self.row_sig[at[p]], self.col_sig[to[p]]]
        return i, j, at, to, value, error

    def _exact(self, at: np.ndarray, to: np.ndarray, metric: Metric) -> np.ndarray:
        return exact(self.a, self.b, self.rows[at], self.cols[to], metric, self.terms)

    def _within(self, rows: slice, cols: slice, eps: float, upper: bool):
        """``sure, i, j``: the pairs of a piece within ``eps``, as a mask and as further places, in laid-out numbers. With ``upper`` the
        piece starts on the diagonal, and only places above it are meant."""
        found = self._compare(rows, cols, eps + self.slack)
        if found is None:
            return None
        total, parts = found
        maybe = total <= self.kind(eps + self.slack)
        sure = total <= self.kind(eps - self.slack) if self.dense else np.zeros_like(maybe)
        if upper:
            side = len(maybe)
            above = np.triu(np.ones((side, side), dtype=bool), 1)
            maybe[:, :side] &= above
            sure[:, :side] &= above
        _, _, at, to, value, error = self._open(rows, cols, maybe ^ sure, total, parts)
        inside = value + error <= eps
        doubt = np.flatnonzero(~inside & (value - error <= eps))
        inside[doubt] = self._exact(at[doubt], to[doubt], self.metric) <= eps
        return sure, at[inside], to[inside]

    def _chunks_within(self, eps: float, half: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of chunks that are within ``eps`` as a whole, and those to be compared; with ``half`` each pair of a block once."""
        inside = self.high + self.most_term <= eps - self.tiny if self.dense else np.zeros(self.high.shape, dtype=bool)
        open_ = ~(self.low > eps + self.tiny) & ~inside
        if half:
            own = inside.diagonal().copy()
            inside, open_ = np.triu(inside, 1), np.triu(open_)
            np.fill_diagonal(open_, open_.diagonal() | own)
        return inside, open_

    def count(self, eps: float, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the weights ``y`` of all points of b within ``eps`` of each point of a, and of ``x`` the other way round. In a
        block that meets itself both are the sums over all other points."""
        n, m = np.zeros(len(self.a)), np.zeros(len(self.b))
        if not len(n) or not len(m):
            return n, m
        x, y = x[self.rows].astype(float), y[self.cols].astype(float)
        # sums of ones over a piece are exact in single precision
        kind = np.float32 if (x == 1).all() and (y == 1).all() else np.float64
        xs, ys = x.astype(kind), y.astype(kind)
        inside, open_ = self._chunks_within(eps, self.same)
        n += np.repeat(inside @ np.add.reduceat(y, self.col_heads), np.diff(np.append(self.row_heads, len(n))))
        m += np.repeat(np.add.reduceat(x, self.row_heads) @ inside, np.diff(np.append(self.col_heads, len(m))))
        for rows, cols in self._pieces(open_):
            found = self._within(rows, cols, eps, self.same and rows.start == cols.start)
            if found is None:
                continue
            sure, at, to = found
            if sure.any():
                sure = sure.astype(kind)
                n[rows] += sure @ ys[cols]
                m[cols] += xs[rows] @ sure
            np.add.at(n, at, y[to])
            np.add.at(m, to, x[at])
        if self.same:
            n = m = n + m
        out_n, out_m = np.empty_like(n), np.empty_like(m)
        out_n[self.rows], out_m[self.cols] = n, m
        return out_n, out_m

    def smallest(self, eps: float, code: np.ndarray, none: int) -> np.ndarray:
        """The smallest ``code`` among the points of b within ``eps`` of each point of a, ``none`` without any."""
        best = np.full(len(self.a), none)
        if not len(self.a) or not len(self.b):
            return best
        code = code[self.cols]
        inside, open_ = self._chunks_within(eps, False)
        least = np.minimum.reduceat(code, self.col_heads)
        best = np.minimum(best, np.repeat(np.where(inside, least[None, :], none).min(axis=1), np.diff(np.append(self.row_heads, len(best)))))
        for rows, cols in self._pieces(open_):
            if code[cols].min() >= best[rows].max():
                continue
            found = self._within(rows, cols, eps, False)
            if found is None:
                continue
            sure, at, to = found
            if sure.any():
                best[rows] = np.minimum(best[rows], np.where(sure, code[cols][None, :], none).min(axis=1))
            np.minimum.at(best, at, code[to])
        out = np.empty_like(best)
        out[self.rows] = best
        return out

    def connect(self, eps: float, label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        """Merge in ``label`` (see ``unite``) the classes of all pairs within ``eps``; rows are the entries ``x`` and ``y``. Chunks that
        are one class already are not compared."""
        if not len(self.a) or not len(self.b):
            return
        x, y = x[self.rows], y[self.cols]
        inside, open_ = self._chunks_within(eps, self.same)
        r, c = np.nonzero(inside)
        unite(label, x[self.row_heads[r]], y[self.col_heads[c]])
        for held, ends, others in ((inside, x, y[self.col_heads]), (inside.T, y, x[self.row_heads])):
            chunk = np.arange(len(ends)) // CHUNK
            met = held.any(axis=1)[chunk]
            unite(label, ends[met], others[held.argmax(axis=1)[chunk[met]]])
        for r in range(len(open_)):
            mine, theirs = label[x[r * CHUNK:(r + 1) * CHUNK]], label[y]
            low, high = np.minimum.reduceat(theirs, self.col_heads), np.maximum.reduceat(theirs, self.col_heads)
            one = (low == high) & (low == mine[0]) & (mine == mine[0]).all()
            for rows, cols in self._pieces((open_[r] & ~one)[None, :], r):
                found = self._within(rows, cols, eps, self.same and rows.start == cols.start)
                if found is None:
                    continue
                sure, at, to = found
                unite(label, x[at], y[to])
                while True:
                    sure &= label[x[rows]][:, None] != label[y[cols]][None, :]
                    hit = sure.any(axis=1)
                    if not hit.any():
                        break
                    unite(label, x[rows][hit], y[cols][sure.argmax(axis=1)[hit]])

    def pairs(self, eps: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows and distances of all pairs within ``eps``, a piece at a time; those of a block that meets itself once."""
        if not len(self.a) or not len(self.b):
            return
        inside, open_ = self._chunks_within(eps, self.same)
        for rows, cols in self._pieces(open_ | inside):
            found = self._compare(rows, cols, eps + self.slack)
            if found is None:
                continue
            maybe = found[0] <= self.kind(eps + self.slack)
            if self.same and rows.start == cols.start:
                maybe[:, :len(maybe)] &= np.triu(np.ones((len(maybe), len(maybe)), dtype=bool), 1)
            _, _, at, to, value, error = self._open(rows, cols, maybe, *found)
            keep = value - error <= eps
            at, to = at[keep], to[keep]
            distance = self._exact(at, to, self.metric)
            keep = distance <= eps
            yield self.rows[at[keep]], self.cols[to[keep]], distance[keep]

    # -- nearest points ----------------------------------------------------------------------------

    def _candidates(self, rows, cols, thr_a, thr_b, k, fa, fb, barred, metric):
        """Pairs of a piece that may be among the ``k`` nearest of a row (further than no ``thr_a``) or of a column (``thr_b``), with
        their exact costs: the distance, or what is larger of ``fa`` and ``fb``. ``barred`` places are left out."""
        total, parts = self._compare(rows, cols)
        floor_a, floor_b = fa[rows], fb[cols]
        if not self.dense:
            total += self.terms[np.ix_(self.row_sig[rows], self.col_sig[cols])].astype(self.kind)
        if barred is not None:
            total[barred] = np.inf
        masks = []
        for axis, thr, own, other in ((1, thr_a, floor_a, floor_b), (0, thr_b, floor_b, floor_a)):
            if thr is None:
                continue
            loose = np.flatnonzero(np.isinf(thr))
            if len(loose):
                # fewer than k points are known: the k-th of this piece bounds what is wanted
                some = total[loose] if axis else total[:, loose].T
                some = np.maximum(np.maximum(some, other.astype(self.kind)[None, :]), own[loose].astype(self.kind)[:, None])
                few = min(k, some.shape[1])
                thr = thr.copy()
                thr[loose] = np.partition(some, few - 1, axis=1)[:, few - 1].astype(float) + 2 * self.slack
            limit = (thr + self.slack).astype(self.kind)
            mask = (total <= limit[:, None]) if axis else (total <= limit[None, :])
            if other.any():
                mask &= (other[None, :] <= thr[:, None]) if axis else (other[:, None] <= thr[None, :])
            masks.append((thr, mask))
        mask = masks[0][1] if len(masks) == 1 else masks[0][1] | masks[1][1]
        if barred is not None:
            mask &= ~barred
        i, j, at, to, value, error = self._open(rows, cols, mask, total, parts)
        if not self.dense:
            value = total.ravel()[i * mask.shape[1] + j].astype(float)
        most = masks[0][0][i] if thr_a is not None else masks[0][0][j]
        if len(masks) > 1:
            most = np.maximum(most, masks[1][0][j])
        keep = np.flatnonzero(value - error <= most)
        at, to = at[keep], to[keep]
        cost = np.maximum(self._exact(at, to, metric), np.maximum(fa[at], fb[to]))
        return at, to, cost

    def lists(self, k: int, fa: np.ndarray, fb: np.ndarray):
        """In laid-out order, the ``k`` points of the other block with the smallest costs, ascending, and their numbers: ``(costs,
        points)`` of a and of b (the same arrays if a block meets itself). Infinite where there are fewer."""
        metric = replace(self.metric, cap=False)
        n, m = len(self.a), len(self.b)
        best_a, at_a = np.full((n, k), np.inf), np.full((n, k), -1)
        best_b, at_b = (best_a, at_a) if self.same else (np.full((m, k), np.inf), np.full((m, k), -1))
        if not n or not m:
            return best_a, at_a, best_b, at_b
        done = np.zeros(self.low.shape, dtype=bool)

        def run(rows: slice, cols: slice) -> None:
            if self.same and rows.start == cols.start and rows.stop == cols.stop:
                i, j, d = self._candidates(rows, cols, best_a[rows, -1], None, k, fa, fb, np.eye(rows.stop - rows.start, dtype=bool), metric)
                _keep_least(best_a, at_a, i, j, d)
                return
            i, j, d = self._candidates(rows, cols, best_a[rows, -1], best_b[cols, -1], k, fa, fb, None, metric)
            _keep_least(best_a, at_a, i, j, d)
            _keep_least(best_b, at_b, j, i, d)

        near = np.where(np.isnan(self.high), np.inf, self.high)
        first = np.zeros_like(done)
        if self.same:
            np.fill_diagonal(first, True)
        else:
            first[np.arange(len(first)), near.argmin(axis=1)] = True
            first[near.argmin(axis=0), np.arange(first.shape[1])] = True
        for r, c in zip(*np.nonzero(first)):
            run(slice(r * CHUNK, min((r + 1) * CHUNK, n)), slice(c * CHUNK, min((c + 1) * CHUNK, m)))
        done |= first | (np.tri(len(done), dtype=bool) if self.same else False)
        for r in range(len(done)):
            most = np.maximum(best_a[r * CHUNK:(r + 1) * CHUNK, -1].max(), np.maximum.reduceat(best_b[:, -1], self.col_heads))
            for rows, cols in self._pieces((~(self.low[r] > most + self.tiny) & ~done[r])[None, :], r):
                run(rows, cols)
        return best_a, at_a, best_b, at_b

    def nearest(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Distances from every point of a to its ``k`` nearest of b, ascending (infinite where there are fewer), and from those of b
        to a. A point is not its own neighbour."""
        best_a, _, best_b, _ = self.lists(k, np.zeros(len(self.a)), np.zeros(len(self.b)))
        out_a, out_b = np.empty_like(best_a), np.empty_like(best_b)
        out_a[self.rows], out_b[self.cols] = best_a, best_b
        return out_a, out_b

    # -- spanning trees ----------------------------------------------------------------------------

    def _outside(self, flip: bool, nodes: np.ndarray, k: int, fa, fb, own_a, own_b, most: np.ndarray):
        """Costs and numbers of the ``k`` cheapest points of other classes for ``nodes`` of a (with ``flip`` of b), if they cost less
        than ``most``."""
        metric = replace(self.metric, cap=False)
        best, at = np.full((len(nodes), k), np.inf), np.full((len(nodes), k), -1)
        size, low = (len(self.a), self.low.T) if flip else (len(self.b), self.low)
        nodes_in = np.argsort(nodes, kind="stable")
        for s in range(0, len(nodes), CHUNK):
            own = nodes_in[s:s + CHUNK]
            some = nodes[own]
            near = low[np.unique(some // CHUNK)].min(axis=0)
            for c in range(0, size, CHUNK * WIDE):
                other = slice(c, min(c + CHUNK * WIDE, size))
                limit = np.minimum(best[own, -1], most[own])
                if (near[c // CHUNK:-(-other.stop // CHUNK)] > limit.max() + self.tiny).all():
                    continue
                if flip:
                    barred = own_a[other][:, None] == own_b[some][None, :]
                    j, i, d = self._candidates(other, some, None, limit, k, fa, fb, barred, metric)
                else:
                    barred = own_a[some][:, None] == own_b[other][None, :]
                    i, j, d = self._candidates(some, other, limit, None, k, fa, fb, barred, metric)
                less = d < most[own][np.searchsorted(some, i)]
                _keep_least(best, at, own[np.searchsorted(some, i[less])], j[less], d[less])
        return best, at

    def tree(self, core_a: np.ndarray, core_b: np.ndarray, known: int = KNOWN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Minimum spanning tree of all pairs (of a block with itself, or of one with the other) under the larger of the distance
        and both ``core`` values: ``(u, v, cost)`` with rows of b numbered after those of a.

        Borůvka's rounds over lists of each point's cheapest partners. A point whose list has only points of its own
        component is looked up again, unless a cheaper edge of the component is known; the largest component may wait, as
        the others grow into it."""
        n, m = len(self.a), len(self.b)
        shift = 0 if self.same else n
        nodes = n if self.same else n + m
        if nodes < 2 or not n or not m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        fa, fb = core_a[self.rows], core_b[self.cols]
        best_a, at_a, best_b, at_b = self.lists(known, fa, fb)
        best = best_a if self.same else np.concatenate([best_a, best_b])
        at = at_a if self.same else np.concatenate([np.where(at_a >= 0, at_a + n, -1), at_b])
        del best_a, at_a, best_b, at_b
        #: what is not listed costs no less
        bound = best[:, -1].copy()
        label = np.arange(nodes)
        edges: list[tuple[np.ndarray, ...]] = []

        def lightest() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            out = (at >= 0) & (label[at] != label[:, None])
            place, has = out.argmax(axis=1), out.any(axis=1)
            every = np.arange(nodes)
            cost = np.where(has, best[every, place], np.inf)
            cheapest = np.full(nodes, np.inf)
            np.minimum.at(cheapest, label, cost)
            return cost, at[every, place], cheapest

        while True:
            sizes = np.bincount(label, minlength=nodes)
            if sizes.max() == nodes:
                break
            cost, to, cheapest = lightest()
            open_ = np.isinf(cost) & (bound < cheapest[label])
            again = np.flatnonzero(open_ & (label != sizes.argmax()))
            if len(again):
                for flip in ((False,) if self.same else (False, True)):
                    mine = again[again >= n] - n if flip else again[again < n]
                    if not len(mine):
                        continue
                    at_node = mine + (n if flip else 0)
                    most = cheapest[label[at_node]]
                    found, who = self._outside(flip, mine, known, fa, fb, label[:n], label[shift:], most)
                    best[at_node], at[at_node] = found, np.where(who >= 0, who + (0 if flip else shift), -1)
                    bound[at_node] = np.minimum(most, found[:, -1])
                cost, to, cheapest = lightest()
                open_ = np.isinf(cost) & (bound < cheapest[label])
            waiting = np.zeros(nodes, dtype=bool)
            waiting[label[open_]] = True
            order = np.lexsort((cost, label))
            heads = order[np.append(True, label[order][1:] != label[order][:-1])]
            heads = heads[np.isfinite(cost[heads]) & ~waiting[label[heads]]]
            picked = _acyclic(label, heads, to[heads])
            if not len(picked):
                break  # what is left has no distance that is a number
            u, v = heads[picked], to[heads][picked]
            edges.append((u, v, cost[u]))
            unite(label, u, v)
        u, v, w = (np.concatenate(c) for c in zip(*edges)) if edges else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        names = self.rows if self.same else np.concatenate([self.rows, self.cols + n])
        return names[u], names[v], w


def _acyclic(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which links of different classes to keep so that they close no circle. Of Borůvka's choices all edges of a circle cost
    the same, so any one of them may go."""
    parent: dict[int, int] = {}

    def find(c: int) -> int:
        while (p := parent.get(c, c)) != c:
            parent[c] = c = parent.get(p, p)
        return c

    kept = []
    for k, (x, y) in enumerate(zip(label[u].tolist(), label[v].tolist())):
        x, y = find(x), find(y)
        if x != y:
            parent[x] = y
            kept.append(k)
    return np.array(kept, dtype=np.int64)


def _keep_least(best: np.ndarray, at: np.ndarray, i: np.ndarray, j: np.ndarray, d: np.ndarray) -> None:
    """Put the candidates ``(i, j, d)`` into the ascending lists of the rows ``i``."""
    k = best.shape[1]
    keep = d < best[i, -1]
    i, j, d = i[keep], j[keep], d[keep]
    if not len(i):
        return
    own = np.unique(i)
    rows = np.concatenate([np.repeat(own, k), i])
    points, costs = np.concatenate([at[own].ravel(), j]), np.concatenate([best[own].ravel(), d])
    order = np.lexsort((costs, rows))
    rows, points, costs = rows[order], points[order], costs[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    best[own], at[own] = costs[keep].reshape(-1, k), points[keep].reshape(-1, k)
