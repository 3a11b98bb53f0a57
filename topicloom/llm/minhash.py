"""MinHash near-duplicates through an inverted join on signature coordinates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import cut, is_empty
from .common import prepare_texts, whole

#: Coordinates of a signature, and how many of them a pair must share. A pair of similarity 0.85 shares fewer than 16 of
#: 32 with a chance of 6e-7.
COORDINATES, MATCHES = 32, 16
#: Rows and shingles of a block of a posting list, two of which meet in a tile; longer lists are cut into blocks.
BLOCK, BLOCK_SHINGLES = 2_048, 2_000_000
#: Rows before it in its posting list that each row is compared with first.
NEIGHBOURS = 2


def shingles(text: bytes, shingle: int) -> set[bytes]:
    """Distinct shingles of the ASCII-lower-cased words; fewer words than ``shingle`` are one, no words none."""
    words = text.lower().split()
    if len(words) <= shingle:
        return {b" ".join(words)} if words else set()
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return {line[a:b] for a, b in zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())}


def multipliers(coordinates: int, seed: int) -> np.ndarray:
    """Odd factors and offsets, one pair per coordinate."""
    pairs = np.random.default_rng(seed).integers(0, 1 << 64, (2, coordinates, 1), np.uint64)
    pairs[0] |= np.uint64(1)
    return pairs


def signature(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Per coordinate, half of the hash that comes first in the coordinate's order of all hashes."""
    step = 4_096
    best = None
    for at in range(0, len(hashes), step):
        h = hashes[at:at + step]
        placed = factors[0] * h + factors[1]
        # the upper bits of a product decide; mixing them down keeps the orders of similar factors apart
        placed ^= placed >> np.uint64(29)
        placed *= np.uint64(0x9E3779B97F4A7C15)
        first = placed.argmin(axis=1)
        found = placed[np.arange(len(first)), first], h[first]
        if best is None:
            best = found
        else:
            lower = found[0] < best[0]
            best = tuple(np.where(lower, new, old) for new, old in zip(found, best))
    return best[1].astype(np.uint32).view(np.int32)


def marks(docs: DataFrame, *, key: str, text: str, shingle: int, coordinates: int, seed: int) -> DataFrame:
    """Written table ``(row, k, t, n, digest, sig)``: number of shingles, digest of their set, signature."""
    key_type = dict(docs.select(key).dtypes)[key]
    factors = multipliers(coordinates, seed)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        one = xxhash.xxh64_intdigest
        for batch in batches:
            n, digest, sig = [], [], []
            for t in batch.column(2):
                found = shingles(t.as_buffer().to_pybytes(), shingle)
                n.append(len(found))
                if found:
                    h = np.sort(np.fromiter((one(x, seed) for x in found), np.uint64, len(found)))
                    digest.append(xxhash.xxh3_128_digest(h.tobytes(), seed))
                    sig.append(signature(h, factors))
                else:
                    digest.append(None)
                    sig.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.list_(pa.int32()))],
                                             ["row", "k", "t", "n", "digest", "sig"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("k"), whole(text).alias("t"))
    return cut(rows.mapInArrow(mark, f"row long, k {key_type}, t string, n long, digest binary, sig array<int>"), "minhash-marks")


def posted(vertices: DataFrame, matches: int) -> DataFrame:
    """Written table ``(key, v)``: each signature under its rarest coordinate values, as many as the match threshold asks for.

    A value that only one signature has matches nothing. Of the ``m`` other values of a signature, in one order of all
    values, any partner with ``matches`` of them has one of the first ``m - matches + 1`` among its own first; longer
    lists are skipped, and signatures with fewer than ``matches`` such values are in no list.
    """
    every = vertices.select("v", F.posexplode("sig").alias("i", "x"))
    every = every.select("v", (F.shiftleft(F.col("i").cast("long"), 32) + F.col("x").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("key"))
    sizes = every.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    held = every.join(sizes, "key").groupBy("v").agg(F.array_sort(F.collect_list(F.struct("size", "key"))).alias("held"))
    first = F.expr(f"slice(held, 1, size(held) - {matches - 1})")
    return cut(held.where(F.size("held") >= matches).select("v", F.explode(first).alias("x")).select("x.key", "v"), "minhash-lists")


def spelled(marked: DataFrame, some: DataFrame, shingle: int, seed: int) -> DataFrame:
    """``(v, h)``: the sorted hashes of the whole shingle sets of ``some`` vertices."""
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        one = xxhash.xxh64_intdigest
        for batch in batches:
            out = []
            for t in batch.column(1):
                found = shingles(t.as_buffer().to_pybytes(), shingle)
                out.append(np.sort(np.fromiter((one(x, seed) for x in found), np.uint64, len(found)).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["v", "h"])

    texts = marked.select(F.col("row").alias("v"), "t").join(some.select("v"), "v", "left_semi")
    return texts.mapInArrow(spell, "v long, h array<long>")


def listed(lists: DataFrame, vertices: DataFrame, marked: DataFrame, shingle: int, seed: int) -> DataFrame:
    """Written table ``(v, n, own, sig, posts)`` of the vertices in a posting list: ``own`` counts the shingles that no
    other of them has, ``posts`` has a bit for each coordinate they are listed under.

    Shingles are told apart by their hashes; hashes that agree can only make ``own`` smaller.
    """
    some = lists.groupBy("v").agg(F.expr("bit_or(shiftleft(1L, cast(shiftright(key, 32) as int)))").alias("posts"))
    single = (spelled(marked, some, shingle, seed).select("v", F.explode("h").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("v"))
              .where("c = 1").groupBy("v").agg(F.count(F.lit(1)).alias("own")))
    return cut(vertices.join(some, "v").join(single, "v", "left").select("v", "n", F.coalesce("own", F.lit(0)).alias("own"), "sig", "posts"), "minhash-listed")


def room(n: str, own: str, m: str, others: str, percent: int) -> Column:
    """Whether sets of these sizes, with so many shingles that no other set has, can be similar enough: they share at
    most the rest of the smaller, and their union holds what is their own and the rest of the larger."""
    a, b = F.col(n) - F.col(own), F.col(m) - F.col(others)
    return 100 * F.least(a, b) >= percent * (F.col(own) + F.col(others) + F.greatest(a, b))


def starred(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct pairs ``(a, b)`` of each row of a posting list with the list's row of the smallest share of own shingles."""
    placed = lists.join(sets.select("v", (F.col("own") / F.col("n")).alias("share")), "v")
    centre = placed.groupBy("key").agg(F.min(F.struct("share", "v")).alias("c")).select("key", F.col("c.v").alias("c"))
    return (lists.join(centre, "key").where("v <> c").select(F.least("v", "c").alias("a"), F.greatest("v", "c").alias("b")).distinct())


def chained(lists: DataFrame) -> DataFrame:
    """Distinct pairs ``(a, b)`` of rows close to each other in a posting list that is ordered at random. A list of any
    length is dealt over tasks in its order; pairs across the border of two tasks are left to :func:`across`."""
    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, v = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            new = len(key)
            key = np.concatenate((key, batch.column(0).to_numpy()))
            v = np.concatenate((v, batch.column(1).to_numpy()))
            for back in range(1, NEIGHBOURS + 1):
                at = np.arange(max(new, back), len(key))
                at = at[key[at] == key[at - back]]
                a, b = v[at], v[at - back]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
            key, v = key[-NEIGHBOURS:], v[-NEIGHBOURS:]

    order = lists.select("key", "v", F.xxhash64("v").alias("o"))
    return order.repartitionByRange("key", "o").sortWithinPartitions("key", "o").select("key", "v").mapInArrow(pair, "a long, b long").distinct()


class Tile:
    """Rows of one tile: vertices of one or two blocks of a posting list."""

    def __init__(self, rows: pa.Table, matches: int, percent: int):
        self.rows, self.matches, self.percent = rows, matches, percent
        self.v, self.root, n, self.own, posts, self.block, self.other, at = (
            rows.column(c).to_numpy() for c in ("v", "root", "n", "own", "posts", "block", "other", "at"))
        self.rest, self.at = n - self.own, int(at[0])
        self.sig = rows.column("sig").combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
        self.posts = (posts[:, None] >> np.arange(self.sig.shape[1])) & 1 == 1

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of different components with room for the similarity and enough common coordinates.

        Of the lists that a pair shares, the one of the first coordinate has it, and of that list's tiles one.
        """
        for s in range(1, len(self.v)):
            a = np.arange(len(self.v) - s)
            low, high = np.minimum(self.rest[a], self.rest[a + s]), np.maximum(self.rest[a], self.rest[a + s])
            a = a[(self.root[a] != self.root[a + s]) & (100 * low >= self.percent * (self.own[a] + self.own[a + s] + high))
                  & ((self.block[a] != self.block[a + s]) | (self.block[a] == self.other[a]))]
            same = self.sig[a] == self.sig[a + s]
            keep = same.sum(axis=1) >= self.matches
            a, same = a[keep], same[keep]
            a = a[(same & self.posts[a] & self.posts[a + s]).argmax(axis=1) == self.at]
            if len(a):
                yield a, a + s

    def paired(self) -> np.ndarray:
        """Which rows are in some pair."""
        found = np.zeros(len(self.v), bool)
        for a, b in self.pairs():
            found[a] = found[b] = True
        return found

    def links(self) -> Iterator[tuple[int, int]]:
        """Pairs whose sets are similar enough and that earlier links of the tile do not connect."""
        sets = [x.as_py() for x in self.rows.column("h")]
        sets = [np.array(x, np.int64) for x in sets]
        label = np.unique(self.root, return_inverse=True)[1]
        for left, right in self.pairs():
            for a, b in zip(left.tolist(), right.tolist()):
                if label[a] == label[b]:
                    continue
                x, y = sets[a], sets[b]
                place = np.searchsorted(x, y)
                both = int((x[np.minimum(place, len(x) - 1)] == y).sum())
                if 100 * both >= self.percent * (len(x) + len(y) - both):
                    label[label == label[b]] = label[a]
                    yield int(self.v[a]), int(self.v[b])


def tiles(batches: Iterator[pa.RecordBatch], matches: int, percent: int) -> Iterator[Tile]:
    """The tiles of sorted batches."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        kept.append(batch)
        name = batch.column(0).to_numpy()
        if kept[0].column(0)[0].as_py() == name[-1]:
            continue
        rows = pa.Table.from_batches(kept)
        name = rows.column(0).to_numpy()
        ends = np.flatnonzero(np.diff(name)) + 1
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
            yield Tile(rows.slice(a, b - a), matches, percent)
        kept = rows.slice(ends[-1]).combine_chunks().to_batches()
    if kept:
        rows = pa.Table.from_batches(kept)
        ends = [*(np.flatnonzero(np.diff(rows.column(0).to_numpy())) + 1).tolist(), len(rows)]
        for a, b in zip([0, *ends[:-1]], ends):
            yield Tile(rows.slice(a, b - a), matches, percent)


def across(lists: DataFrame, sets: DataFrame, roots: DataFrame, marked: DataFrame, shingle: int, seed: int, matches: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of one posting list whose sets' hashes are similar enough and that are in different components.

    Only lists that span several components are read again. Lists of more than ``BLOCK`` rows, or ``BLOCK_SHINGLES``
    shingles, are cut into blocks, whose pairs go to different tasks. A first pass finds the rows of each tile that
    have a partner with :func:`room` and enough common coordinates; only these meet again with their sets. A task
    returns at most one pair per row, whatever the number of pairs it compares.
    """
    members = lists.join(roots.select(F.col("id").alias("v"), "root"), "v", "left").withColumn("root", F.coalesce("root", "v"))
    members = members.join(sets, "v")
    several = (members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"), F.min("root").alias("x"), F.max("root").alias("y"))
               .where("x <> y").select("key", F.ceil(F.greatest(F.col("size") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    dealt = (members.join(several, "key").withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    name = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("tile")
    fields = "tile long, v long, root long, n long, own long, posts long, block int, other int, at long, sig array<int>"
    met = dealt.select(name, "v", "root", "n", "own", "posts", "block", "other", F.shiftright("key", 32).alias("at"), "sig")

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in tiles(batches, matches, percent):
            yield from tile.rows.filter(pa.array(tile.paired())).combine_chunks().to_batches()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in tiles(batches, matches, percent):
            found = list(tile.links())
            yield pa.RecordBatch.from_arrays([pa.array([min(x) for x in found], pa.int64()), pa.array([max(x) for x in found], pa.int64())], ["a", "b"])

    some = cut(met.repartition("tile").sortWithinPartitions("tile").mapInArrow(narrow, fields), "minhash-narrow")
    spelt = spelled(marked, some.select("v").distinct(), shingle, seed)
    return (some.join(spelt, "v").select(*[c.split()[0] for c in fields.split(", ")], "h").repartition("tile").sortWithinPartitions("tile")
            .mapInArrow(settle, "a long, b long").distinct())


def confirmed(pairs: DataFrame, marked: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those of the pairs whose whole shingle sets are similar enough, as written links ``(u, v)``."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, set()
        for batch in batches:
            keep = []
            for b, tb, ta in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if b != last:
                    last, x = b, shingles(tb.as_buffer().to_pybytes(), shingle)
                y = shingles(ta.as_buffer().to_pybytes(), shingle)
                both = len(x & y)
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            found = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([found.column(0), found.column(1)], ["u", "v"])

    texts = marked.select("row", "t")
    of = (pairs.join(texts.select(F.col("row").alias("a"), F.col("t").alias("ta")), "a")
          .join(texts.select(F.col("row").alias("b"), F.col("t").alias("tb")), "b").select("a", "b", "tb", "ta"))
    return cut(of.mapInArrow(verify, "u long, v long"), "minhash-links")


def alike(a: str, b: str) -> Column:
    """How many coordinates two signatures share."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3, percent: int = 85,
                    coordinates: int = COORDINATES, matches: int = MATCHES, seed: int = 42) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` per row of ``docs``.

    Documents link if their sets of word shingles share at least ``percent`` of 100 of their union. Equal sets are one
    vertex, and the signatures of the others are posted by coordinate and value. Rows that meet in a posting list
    and share ``matches`` coordinates are settled by their whole sets: first each with its list's row of the fewest
    shingles of its own and with neighbours in lists ordered at random, then all pairs that lists still hold of
    different components. Pairs whose own shingles rule the similarity out are passed over.

    ``component_id`` is the smallest key that can be reached and ``kept`` marks the row that has it. Null and empty
    texts and those without a word have no shingles, link with nothing and stay. Rows without a key get the smallest
    key of their component, null if there is none, and are kept only in its stead; of rows with one key in a
    component one is kept, in different components each for itself. Texts are read whole, whatever their length.
    An empty table gives an empty result; other columns are ignored.
    """
    prepare_texts(docs.sparkSession)
    marked = marks(docs, key=key, text=text, shingle=shingle, coordinates=coordinates, seed=seed)
    some = marked.where("n > 0")
    kinds = cut(some.groupBy("digest").agg(F.min("row").alias("v")), "minhash-kinds")
    vertices = cut(some.select(F.col("row").alias("v"), "n", "sig").join(kinds.select("v"), "v", "left_semi"), "minhash-vertices")
    lists = posted(vertices, matches)
    sets = listed(lists, vertices, marked, shingle, seed)
    lists = cut(lists.join(sets.where(100 * (F.col("n") - F.col("own")) >= percent * F.col("n")).select("v"), "v", "left_semi"), "minhash-open")
    first = cut(starred(lists, sets).unionByName(chained(lists)).distinct(), "minhash-first")
    a, b = (sets.select(F.col("v").alias(x), F.col("n").alias(f"n{x}"), F.col("own").alias(f"own{x}"), F.col("sig").alias(f"s{x}")) for x in "ab")
    likely = (first.join(a, "a").join(b, "b").where(room("na", "owna", "nb", "ownb", percent)).where(alike("sa", "sb") >= matches).select("a", "b"))
    links = confirmed(likely, marked, shingle, percent)
    roots = cut(connected_components(links), "minhash-roots")
    rest = cut(across(lists, sets, roots, marked, shingle, seed, matches, percent), "minhash-rest")
    if not is_empty(rest):
        roots = cut(connected_components(links.unionByName(confirmed(rest, marked, shingle, percent))), "minhash-roots")
    root_of = kinds.join(roots.withColumnRenamed("id", "v"), "v", "left").select("digest", F.coalesce("root", "v").alias("root"))
    members = cut(marked.select("row", "k", "n", "digest").join(root_of, "digest", "left")
                  .select("row", "k", "n", F.coalesce("root", "row").alias("root")), "minhash-members")
    lowest = (members.groupBy("root").agg(F.min(F.struct(F.col("k").isNull().alias("none"), "k", "row")).alias("m"))
              .select("root", F.col("m.k").alias("component_id"), F.col("m.row").alias("first")))
    return members.join(lowest, "root").select(F.col("k").alias(key), F.col("n").alias("n_shingles"), "component_id",
                                               (F.col("row") == F.col("first")).alias("kept"))
