"""Fragments of texts that may repeat elsewhere: rolling hashes, a count-min sketch and exact groups.

A *window* is a fixed number of consecutive items (bytes or words). Every window has an *anchor*, the smallest hash
among the shorter grams inside it, so equal windows have equal anchors wherever they stand. Consecutive windows of
one anchor form a *fragment*; fragments are about ten times fewer than bytes and are what Spark groups.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, scratch_scope
from .common import settled, slices

#: Cells of each of the two sketch rows, by input, within these bounds: at most 64 MB of bits in all, whatever the
#: input. Beyond it the sketch passes more fragments on to the exact groups; the result stays the same.
MIN_CELLS, MAX_CELLS, ROWS = 1 << 22, 1 << 28, 2
CELLS_PER_FRAGMENT = 5
#: Powers of two: cells of a chunk (16-bit numbers) and of a region, which one task merges.
CHUNK, REGION = 16, 20
#: Characters that are hashed together, few enough for the arrays to stay in a core's cache, and anchors that a
#: task counts or marks at a time.
SLICE_CHARS, COUNTED, MARKED = 120_000, 2_000_000, 500_000
#: Windows of a fragment at most; longer ones (periodic texts) are cut.
MAX_RUN = 64
#: Odd multipliers of the two hashes; any odd numbers will do, as codes are 64 bits wide.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

FRAGMENT = "anchor long, digest long, k long, at long, n int"


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of the low bits over all bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class RangeHash:
    """64-bit hashes of runs of items: differences of a running polynomial sum over the items' codes, brought to a
    common place. A code of a word is half of its 128-bit XXH3 digest, that of a byte a drawn odd number. Sums modulo
    2^64 agree for certain texts whatever the base, but only from 1,024 items on; runs are ten times shorter."""

    def __init__(self, index: int):
        self.index, self.base, self.inverse = index, BASES[index], pow(BASES[index], -1, 1 << 64)
        self.values = np.random.default_rng(index).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.empty(0, np.uint64)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[:1] = 1
        return np.multiply.accumulate(out)

    def load(self, items: Items) -> None:
        codes = self.values[items.data] if items.digests is None else items.digests[:, self.index]
        if len(self.up) <= len(codes):
            n = len(codes) + len(codes) // 4 + 1
            self.up, self.down = self._powers(self.base, n), self._powers(self.inverse, n)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * self.up[:len(codes)], out=self.sums[1:])

    def __call__(self, first: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Hashes of the runs of ``n`` items from each ``first``."""
        return mixed((self.sums[first + n] - self.sums[first]) * self.down[first])

    def every(self, n: int) -> np.ndarray:
        """Hashes of all runs of ``n`` items."""
        return mixed((self.sums[n:] - self.sums[:-n]) * self.down[:len(self.sums) - n])


class Items:
    """Items of several UTF-8 texts in one buffer: byte ranges and the number of the first item of each text; of words
    also the two halves of their digests."""

    def __init__(self, raw: list[bytes], words: bool):
        if words:
            from xxhash import xxh3_128_digest

            split = [r.split() for r in raw]
            counts = np.array([len(w) for w in split], np.int64)
            flat = [w for ws in split for w in ws]
            lengths = np.fromiter(map(len, flat), np.int64, len(flat))
            self.data = np.frombuffer(b" ".join(flat), np.uint8)
            self.starts = np.cumsum(lengths + 1) - lengths - 1
            self.ends = self.starts + lengths
            self.digests = np.frombuffer(b"".join(map(xxh3_128_digest, flat)), "<u8").reshape(-1, 2)
        else:
            counts = np.array([len(r) for r in raw], np.int64)
            self.data = np.frombuffer(b"".join(raw), np.uint8)
            self.starts = np.arange(len(self.data))
            self.ends = self.starts + 1
            self.digests = None
        self.counts, self.first = counts, np.cumsum(counts) - counts

    def runs(self, hashes: RangeHash, window: int, gram: int) -> tuple[np.ndarray, ...]:
        """Text, first item, windows and anchor of each fragment."""
        n = len(self.starts)
        if n < window:
            return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
        low = hashes.every(gram)
        span, held = window - gram + 1, 1
        while 2 * held <= span:
            low, held = np.minimum(low[:-held], low[held:]), 2 * held
        if held < span:
            low = np.minimum(low[:held - span], low[span - held:])
        # windows that stay inside a text
        inside = np.zeros(n + 1, np.int32)
        long = self.counts >= window
        np.add.at(inside, self.first[long], 1)
        np.add.at(inside, (self.first + self.counts - window + 1)[long], -1)
        valid = np.cumsum(inside[:len(low)]) > 0
        new = np.empty(len(low), bool)
        new[0] = True
        new[1:] = (low[1:] != low[:-1]) | ~valid[:-1]
        new[self.first[long]] = True
        new &= valid
        head = np.flatnonzero(new)
        stop = np.concatenate((head[1:], [len(low)]))
        # the last fragment of a text ends with the text's last window
        text = np.searchsorted(self.first, head, side="right") - 1
        stop = np.minimum(stop, self.first[text] + self.counts[text] - window + 1)
        size = stop - head
        parts = -(-size // MAX_RUN)
        if len(parts) and parts.max() > 1:
            text, anchor = np.repeat(text, parts), np.repeat(low[head], parts)
            step = (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * MAX_RUN
            size = np.minimum(np.repeat(size, parts) - step, MAX_RUN)
            return text, np.repeat(head, parts) + step, size, anchor
        return text, head, size, low[head]


def regions(cells: np.ndarray, row: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Counts of cells by chunk: region, chunk, and the 16-bit numbers of cells counted once and more often."""
    cell, n = np.unique(cells, return_counts=True)
    chunk = cell >> np.uint64(CHUNK)
    low = cell.astype("<u2")
    edges = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1], [True]))) if len(cell) else []
    for a, b in zip(edges[:-1], edges[1:]):
        c = int(chunk[a])
        one = n[a:b] == 1
        yield (row << 32) + (c >> (REGION - CHUNK)), c & ((1 << (REGION - CHUNK)) - 1), low[a:b][one].tobytes(), low[a:b][~one].tobytes()


def region_batch(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["region", "chunk", "once", "more"])


def merged_bits(counted: DataFrame, cells: int) -> np.ndarray:
    """Sum partial counts by region and return one bit per cell and row: counted twice or more."""
    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1 << REGION, np.uint8)
        for b in batches:
            for chunk, once, more in zip(*(b.column(c).to_pylist() for c in ("chunk", "once", "more"))):
                at = chunk << CHUNK
                one = at + np.frombuffer(once, "<u2").astype(np.int64)
                n[one] = np.minimum(n[one] + 1, 2)  # a batch may hold more rows of a cell than a byte counts
                n[at + np.frombuffer(more, "<u2").astype(np.int64)] = 2
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()]), pa.array([np.packbits(n > 1).tobytes()], pa.binary())],
                                         ["region", "bits"])

    merged = counted.groupBy("region").applyInArrow(merge, "region long, bits binary")
    out, width = np.zeros((ROWS, cells // 8), np.uint8), (1 << REGION) // 8
    for r in cut(merged, "sketch-bits").toLocalIterator():  # ROWS * MAX_CELLS / 8 bytes at most in all
        row, at = r["region"] >> 32, (r["region"] & 0xFFFFFFFF) * width
        out[row, at:at + width] = np.frombuffer(r["bits"], np.uint8)
    return out


def cell(anchors: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (anchors >> np.uint64(34 * row)) & np.uint64(cells - 1)


def held(bits: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Whether every row of the sketch has the anchor's bit."""
    yes = np.ones(len(anchors), bool)
    for row in range(ROWS):
        at = cell(anchors, row, bits.shape[1] * 8)
        yes &= (bits[row][(at >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
    return yes


class Finder:
    """Fragments of the texts of a table ``(k, t)`` for windows of so many items with grams of so many."""

    def __init__(self, texts: DataFrame, window: int, gram: int, words: bool):
        self.texts, self.window, self.gram, self.words = texts, window, gram, words
        total = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        density = 2 / (window - gram + 2) / (6 if words else 1)
        self.shared: list = []
        self.cells = MIN_CELLS
        while self.cells < min(MAX_CELLS, total * density * CELLS_PER_FRAGMENT):
            self.cells *= 2

    def release(self) -> None:
        """Free the bits on executors; a task that is run again gets them anew."""
        for b in self.shared:
            b.unpersist()
        self.shared.clear()

    def _walk(self) -> Callable:
        window, gram, words = self.window, self.gram, self.words

        def walk(batches: Iterator[pa.RecordBatch]):
            hashes = RangeHash(0)
            for batch in batches:
                texts = batch.column(1).to_pylist()
                for a, b in slices(texts, SLICE_CHARS):
                    raw = [t.encode() for t in texts[a:b]]
                    items = Items(raw, words)
                    hashes.load(items)
                    yield batch.slice(a, b - a), raw, items, *items.runs(hashes, window, gram)

        return walk

    def sketch(self) -> np.ndarray:
        """Count-min over the anchors of all fragments: each task counts its own, and the counts are merged."""
        walk, cells = self._walk(), self.cells

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: list[np.ndarray] = []
            for *_, anchor in walk(batches):
                found.append(anchor)
                if sum(map(len, found)) > COUNTED:
                    anchors = np.concatenate(found)
                    found.clear()
                    for row in range(ROWS):
                        yield region_batch(list(regions(cell(anchors, row, cells), row)))
            if found:
                anchors = np.concatenate(found)
                for row in range(ROWS):
                    yield region_batch(list(regions(cell(anchors, row, cells), row)))

        return merged_bits(self.texts.select("k", "t").mapInArrow(count, "region long, chunk int, once binary, more binary"), cells)

    def bits_of(self, anchors: DataFrame) -> np.ndarray:
        """Bits of the cells of the given anchors (a written table), sixteen cells for each within the bounds."""
        cells, n = MIN_CELLS, anchors.count()
        while cells < min(MAX_CELLS, 16 * n):
            cells *= 2

        def marks(anchors: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            a = np.repeat(np.concatenate(anchors), 2)
            for row in range(ROWS):
                yield region_batch(list(regions(cell(a, row, cells), row)))

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept, n = [], 0
            for b in batches:
                kept.append(b.column(0).to_numpy().view(np.uint64))
                n += len(kept[-1])
                if n > MARKED:
                    yield from marks(kept)
                    kept, n = [], 0
            if kept:
                yield from marks(kept)

        return merged_bits(anchors.select("anchor").mapInArrow(mark, "region long, chunk int, once binary, more binary"), cells)

    def fragments(self, bits: np.ndarray, content: bool = False) -> DataFrame:
        """Fragments whose anchor the sketch holds; ``at`` has the text's checksum above and its first item below bit 32.
        With ``content`` also the bytes from the first to the last item."""
        walk, window = self._walk(), self.window
        shared = self.texts.sparkSession.sparkContext.broadcast(bits)
        self.shared.append(shared)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from zlib import crc32

            bits_, digests = shared.value, RangeHash(1)
            for batch, raw, items, text, head, size, anchor in walk(batches):
                yes = held(bits_, anchor)
                if not yes.any():
                    continue
                text, head, size, anchor = text[yes], head[yes], size[yes], anchor[yes]
                digests.load(items)
                many = size + window - 1
                tags = np.fromiter(map(crc32, raw), np.int64, len(raw))
                columns = [pa.array(anchor.view(np.int64)), pa.array(digests(head, many).view(np.int64)),
                           batch.column(0).take(pa.array(text)), pa.array((tags[text] << 32) + head - items.first[text]), pa.array(size.astype(np.int32))]
                names = ["anchor", "digest", "k", "at", "n"]
                if content:
                    data, starts, ends = items.data.tobytes(), items.starts[head], items.ends[head + many - 1]
                    columns.append(pa.array([data[a:b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary()))
                    names.append("content")
                yield pa.RecordBatch.from_arrays(columns, names)

        return self.texts.select("k", "t").mapInArrow(find, FRAGMENT + ", content binary" * content)


def windows_in_smaller(distinct: DataFrame, window: int, words: bool) -> DataFrame:
    """``(anchor, digest, offsets)``: windows of distinct fragments ``(anchor, digest, low, content)`` that also start in a
    fragment of a smaller ``low``. All windows are grouped by a 128-bit hash, which combines before the shuffle."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = RangeHash(0), RangeHash(1)
        for b in batches:
            items = Items(b.column("content").to_pylist(), words)
            many = items.counts - window + 1
            own = np.repeat(np.arange(len(many)), many)
            offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            a = items.first[own] + offset
            one.load(items)
            two.load(items)
            take = pa.array(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one(a, window).view(np.int64)), pa.array(two(a, window).view(np.int64)), b.column("low").take(take), b.column("anchor").take(take),
                 b.column("digest").take(take), pa.array(offset.astype(np.int32))], ["h1", "h2", "low", "anchor", "digest", "o"])

    rows = distinct.select("anchor", "digest", "low", "content").mapInArrow(
        spread, "h1 long, h2 long, low long, anchor long, digest long, o int")
    first = rows.groupBy("h1", "h2").agg(F.min("low").alias("first"), F.max("low").alias("top")).where("first < top").drop("top")
    return (rows.join(first, ["h1", "h2"]).where("first < low").groupBy("anchor", "digest")
            .agg(F.array_sort(F.collect_set("o")).alias("offsets")))


def repeated_ranges(finder: Finder, inner: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """``(k, tag, ranges)``: for each text, the ranges ``(a, b)`` of first items of windows that also start under a smaller ``k``.

    Equal fragments are reduced to their smallest key: under larger keys all their windows are repeated. Windows can
    also be shared by different fragments of one anchor; ``inner`` finds these among distinct fragments
    ``(anchor, digest, low, content, kinds)``, each once however often it occurs. Texts are hashed three times, as
    to write all fragments would take more room than the texts.
    """
    with scratch_scope(finder.texts.sparkSession):
        groups = cut(finder.fragments(finder.sketch()).groupBy("anchor", "digest").agg(F.min("k").alias("low"), F.max("k").alias("high")),
                     f"{name}-groups")
        finder.release()
        several = cut(groups.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("low").alias("a"), F.max("low").alias("b"))
                      .where("kinds > 1 and a < b").select("anchor", "kinds"), f"{name}-several")
        distinct = (finder.fragments(finder.bits_of(several), content=True).groupBy("anchor", "digest")
                    .agg(F.min("k").alias("low"), F.first("content").alias("content")).join(several, "anchor"))
        distinct = cut(distinct, f"{name}-distinct")
        finder.release()
        offsets = inner(distinct)
        known = settled(groups.join(offsets, ["anchor", "digest"], "left").where("low < high or offsets is not null")
                        .select("anchor", "digest", "low", "offsets"), f"{name}-known")
    at, n = F.col("at").bitwiseAND(F.lit((1 << 32) - 1)), F.col("n").cast("long")
    # a range as one number, its end below bit 32: numbers take least room where equal ones of rows alike are told apart
    packed = lambda a, b: F.shiftleft(a, 32) + b
    some = F.transform(F.coalesce("offsets", F.array().cast("array<int>")), lambda o: packed(at + o, at + o + 1))
    found = finder.fragments(finder.bits_of(known))
    ranges = (found.join(known, ["anchor", "digest"])
              .select("k", F.shiftrightunsigned("at", 32).alias("tag"),
                      F.explode(F.when(F.col("k") > F.col("low"), F.array(packed(at, at + n))).otherwise(some)).alias("r"))
              .groupBy("k", "tag").agg(F.collect_set("r").alias("r")))
    return ranges.select("k", "tag", F.transform("r", lambda x: F.struct(
        F.shiftright(x, 32).alias("a"), x.bitwiseAND(F.lit((1 << 32) - 1)).alias("b"))).alias("ranges"))


def with_ranges(finder: Finder, rows: DataFrame, ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` ``(key, k, t)`` that may have ranges, joined with them, and those that have none.

    A bit per key of a text with ranges tells them apart, so that only texts which lose something move.
    """
    bits = finder.bits_of(ranges.select(F.xxhash64("k").alias("anchor")))
    shared = rows.sparkSession.sparkContext.broadcast(bits)
    rows = rows.select("key", "k", "t", F.xxhash64("k").alias("h"))

    def only(wanted: bool) -> Callable:
        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits_ = shared.value
            for b in batches:
                h = b.column(3).to_numpy().view(np.uint64)
                yield b.filter(pa.array(held(bits_, h) == wanted))

        return walk

    some, none = (rows.mapInArrow(only(w), rows.schema) for w in (True, False))
    joined = (some.withColumn("tag", F.crc32(F.col("t").cast("binary"))).join(ranges, ["k", "tag"], "left").select("key", "t", "ranges"))
    return joined, none.select("key", "t", F.lit(None).cast(ranges.schema["ranges"].dataType).alias("ranges"))


def range_arrays(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of the ranges of each row; none for null."""
    edges, (a, b) = column.offsets.to_numpy(), (x.to_numpy() for x in column.values.flatten())
    for i, j, valid in zip(edges[:-1].tolist(), edges[1:].tolist(), column.is_valid().to_pylist()):
        yield (a[i:j], b[i:j]) if valid else (a[:0], b[:0])


def covered(n: int, ranges: tuple[np.ndarray, np.ndarray], window: int) -> np.ndarray:
    """Flags of the ``n`` items that lie in a repeated window."""
    a, b = ranges
    if not len(a):
        return np.zeros(n, bool)
    edge = np.bincount(a, minlength=n + 1)[:n + 1] - np.bincount(b + window - 1, minlength=n + 1)[:n + 1]
    return np.cumsum(edge[:n]) > 0
