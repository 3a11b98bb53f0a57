"""Removal of repeated byte strings by suffix arrays of shards, sorted by induction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import prepare_texts, settled, whole
from .repeats import Finder, covered, range_arrays, repeated_ranges, windows_in_smaller, with_ranges

#: Bytes of the grams that anchor a window, and of the text of one shard on average.
GRAM, SHARD_BYTES = 24, 1_000_000
#: Distinct fragments of one anchor that a shard takes; the windows of larger anchors are grouped by their hash.
SHARD_KINDS = 4_096
#: Bucket numbers up to which a reduced string is sorted by induction again; beyond it by doubling.
INDUCED_NAMES = 2_048


def _stable_put(sa: np.ndarray, chars: np.ndarray, items: np.ndarray, edge: np.ndarray, step: int) -> None:
    """Put items at the running edges of their buckets, in order, and move the edges."""
    order = np.argsort(chars, kind="stable")
    c = chars[order]
    first = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
    size = np.diff(np.concatenate((first, [len(c)])))
    rank = np.arange(len(c)) - np.repeat(first, size)
    sa[edge[c] + step * rank] = items[order]
    edge[c[first]] += step * size


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix array induced from leftmost-smaller positions in the given order.

    Buckets are visited in turn and their entries handled together, which keeps the order of a scan: what a bucket
    induces in itself (runs of one symbol) is handled in further waves.
    """
    starts = np.concatenate(([0], ends[:-1]))
    n = len(t)
    sa = np.full(n, -1, np.int64)
    tail = ends - 1
    if len(lms):
        _stable_put(sa, t[lms[::-1]], lms[::-1], tail, -1)
    used = np.flatnonzero(ends > starts)
    head = starts.copy()
    at_lms = tail + 1  # where the leftmost-smaller entries of a bucket begin
    # the last suffix comes first among those it would be compared with
    if not small[n - 1]:
        sa[head[t[n - 1]]] = n - 1
        head[t[n - 1]] += 1

    def forward(entries: np.ndarray) -> None:
        before = entries[entries > 0] - 1
        before = before[~small[before]]
        if len(before):
            _stable_put(sa, t[before], before, head, 1)

    for c in used:
        done = starts[c]
        while done < head[c]:
            done, wave = head[c], sa[done:head[c]]
            forward(wave)
        if at_lms[c] < ends[c]:
            forward(sa[at_lms[c]:ends[c]].copy())
    for c in used:  # smaller suffixes are induced anew
        sa[head[c]:ends[c]] = -1
    tail = ends - 1

    def backward(entries: np.ndarray) -> None:
        before = entries[entries > 0] - 1
        before = before[small[before]]
        if len(before):
            _stable_put(sa, t[before], before, tail, -1)

    for c in used[::-1]:
        done = ends[c] - 1
        while done > tail[c]:
            done, wave = tail[c], sa[tail[c] + 1:done + 1][::-1].copy()
            backward(wave)
        if starts[c] < head[c]:
            backward(sa[starts[c]:head[c]][::-1].copy())
    return sa


def _doubled(names: np.ndarray) -> np.ndarray:
    """Suffix array of a string by doubling the compared length."""
    rank, width = names.astype(np.int64), 1
    n = len(rank)
    while True:
        second = np.zeros(n, np.int64)
        second[:n - width] = rank[width:] + 1
        pair = rank * (n + max(2, int(names.max()) + 2)) + second
        order = np.argsort(pair)
        new = np.concatenate(([0], np.cumsum(pair[order][1:] != pair[order][:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or width >= n:
            return order
        width *= 2


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of an array of small numbers in ascending order.

    Suffixes are larger or smaller than the next one; leftmost-smaller positions cut the string into substrings, which
    induction sorts and which are then named. If names repeat, the string of names is sorted in the same way and its
    order induces that of all suffixes. A string of very many names has too many buckets to visit, so its
    suffixes are sorted by doubling.
    """
    n = len(t)
    # small numbers are sorted by their digits
    t = np.asarray(t, np.uint16 if n and np.max(t) < 1 << 16 else np.int64)
    if n < 2:
        return np.arange(n)
    # a suffix is smaller than the next if its symbol is, or an equal symbol's suffix is; the last one is larger
    change = np.concatenate((t[1:] != t[:-1], [True]))
    up = np.concatenate((t[:-1] < t[1:], [False]))
    nearest = np.flatnonzero(change)[np.cumsum(np.concatenate(([0], change[:-1])))]
    small = up[nearest]
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    ends = np.cumsum(np.bincount(t))
    if not len(lms):
        return _induce(t, small, lms, ends)
    rough = _induce(t, small, lms, ends)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = rough[is_lms[rough]]
    # neighbours in this order are equal substrings if all their symbols are
    length = np.empty(n, np.int64)
    length[lms] = np.diff(np.concatenate((lms, [n])))
    a, b = order[:-1], order[1:]
    differ = length[a] != length[b]
    open_ = np.flatnonzero(~differ)
    for i in range(int(length[order].max()) + 1):
        reach = np.maximum(a[open_], b[open_]) + i
        out = reach >= n
        differ[open_[out]] = True
        open_ = open_[~out]
        unequal = t[a[open_] + i] != t[b[open_] + i]
        differ[open_[unequal]] = True
        open_ = open_[~unequal]
        open_ = open_[i < length[a[open_]]]
        if not len(open_):
            break
    name = np.empty(n, np.int64)
    name[order] = np.concatenate(([0], np.cumsum(differ)))
    reduced = name[lms]
    if reduced.max() == len(lms) - 1:
        inner = np.empty(len(lms), np.int64)
        inner[reduced] = np.arange(len(lms))
    elif reduced.max() < INDUCED_NAMES:
        inner = suffix_array(reduced)
    else:
        inner = _doubled(reduced)
    return _induce(t, small, lms[inner], ends)


def permuted_common_prefixes(data: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """For each position in text order, the symbols its suffix shares with the one before it in the array, ``limit`` at most."""
    n = len(data)
    # four symbols, each one higher, to a word; 0 stands behind the end, which two suffixes never reach together
    room = np.zeros(n + limit + 8, np.uint64)
    room[:n] = np.asarray(data, np.uint64) + np.uint64(1)
    words = room[:-3] | room[1:-2] << np.uint64(16) | room[2:-1] << np.uint64(32) | room[3:] << np.uint64(48)
    shared = np.zeros(n, np.int64)
    a, b = sa[:-1], sa[1:]
    for i in range(0, limit, 4):
        unlike = words[a + i] ^ words[b + i]
        same = unlike == 0
        shared[b] += sum((unlike & np.uint64((1 << 16 * k) - 1) == 0).astype(np.int64) for k in (1, 2, 3)) + same
        a, b = a[same], b[same]
        if not len(a):
            break
    return np.minimum(shared, limit)


def windows_by_suffixes(parts: list[bytes], lows: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Part and offset of each window that also starts in a part of smaller low."""
    lengths = np.array([len(p) for p in parts], np.int64)
    # symbol 0 ends each part, so a window's prefix never runs into the next part
    data = np.zeros(int(lengths.sum()) + len(parts), np.int16)
    own = np.repeat(np.arange(len(parts)), lengths + 1)
    first = np.cumsum(lengths + 1) - lengths - 1
    body = np.ones(len(data), bool)
    body[first + lengths] = False
    data[body] = np.frombuffer(b"".join(parts), np.uint8).astype(np.int16) + 1
    sa = suffix_array(data)
    same = permuted_common_prefixes(data, sa, window)[sa] >= window
    offset = np.arange(len(data)) - first[own]
    whole_window = offset + window <= lengths[own]
    # neighbours that share a window are one group; symbol 0 keeps shorter suffixes out of it
    group = np.cumsum(~(same & whole_window[sa]))
    low = np.full(group[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(low, group[whole_window[sa]], lows[own[sa]][whole_window[sa]])
    hit = whole_window[sa] & (low[group] < lows[own[sa]])
    at = np.sort(sa[hit])
    return own[at], offset[at]


def windows_in_shards(distinct: DataFrame, window: int) -> DataFrame:
    """``(anchor, digest, offsets)`` as :func:`windows_in_smaller`, from suffix arrays of shards of bounded size. All
    fragments of an anchor are in one shard; anchors with more than ``SHARD_KINDS`` are grouped by hash instead."""
    usual, crowded = distinct.where(F.col("kinds") <= SHARD_KINDS), distinct.where(F.col("kinds") > SHARD_KINDS)
    total = usual.agg(F.sum(F.length("content"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))

    def sort(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        part, offset = windows_by_suffixes(table.column("content").to_pylist(), table.column("low").to_numpy(), window)
        some, first = np.unique(part, return_index=True)
        lists = [o.tolist() for o in np.split(offset, first[1:])] if len(some) else []
        take = pa.array(some, pa.int64())
        yield pa.RecordBatch.from_arrays([table.column("anchor").take(take).combine_chunks(), table.column("digest").take(take).combine_chunks(),
                                          pa.array(lists, pa.list_(pa.int32()))], ["anchor", "digest", "offsets"])

    by_shard = (usual.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "digest", "low", "content").groupBy("shard")
                .applyInArrow(sort, "anchor long, digest long, offsets array<int>"))
    return cut(by_shard.unionByName(windows_in_smaller(crowded, window, words=False)), "suffix-windows")


def remove_repeated_strings(docs: DataFrame, *, window: int = 50, gram: int = GRAM, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept)`` per row of ``docs``: what is left of its UTF-8 bytes when every byte is
    removed that lies in a string of ``window`` bytes which also starts under a smaller key.

    Fragments of texts that may repeat are reduced to distinct ones, dealt into shards in which all windows that
    could be equal meet, and each shard's suffix array is sorted by induction; neighbours in it whose permuted
    common prefixes reach ``window`` are equal strings.

    Null text counts as empty, a row without a (whole-number) key is no source and stays as it is, rows of one key are
    never sources for each other, and an empty table gives an empty result. Other columns are ignored.
    """
    prepare_texts(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(key).alias("key"), whole(text).alias("t"))
    finder = Finder(rows.where("k is not null").select("k", "t"), window, gram, words=False)
    ranges = repeated_ranges(finder, lambda d: windows_in_shards(d, window), "strings")
    parts = with_ranges(finder, rows, settled(ranges, "strings-ranges"))
    key_type = dict(docs.dtypes)[key]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, runs, kept = [], [], [], []
            for t, r in zip(batch.column(1), range_arrays(batch.column(2))):
                raw = t.as_py().encode()
                flags = covered(len(raw), r, window)
                n.append(len(raw))
                gone.append(int(flags.sum()))
                runs.append(int((flags[1:] & ~flags[:-1]).sum() + flags[:1].sum()))
                kept.append(np.frombuffer(raw, np.uint8)[~flags].tobytes() if gone[-1] else raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n, gone, runs)), pa.array(kept, pa.binary())],
                                             ["k", "n_bytes", "n_removed", "n_spans", "kept"])

    some, none = (p.mapInArrow(keep, f"k {key_type}, n_bytes long, n_removed long, n_spans long, kept binary") for p in parts)
    return some.unionByName(none).withColumnRenamed("k", key)
