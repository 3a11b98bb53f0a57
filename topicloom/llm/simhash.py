"""SimHash near-duplicates through a byte-position index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import cut, rows_within
from .common import BROADCAST_IDS, prepare_texts, whole

#: Bytes of a fingerprint, and the largest number of differing bits of a link that the index can find.
BYTES, RADIUS = 8, 4
#: Rows of one posting list that meet in one tile; longer lists are cut into blocks.
BLOCK = 4_096
#: Links that a task holds before it reduces them to a spanning forest.
HELD_LINKS = 400_000


def index_triples() -> list[tuple[int, int, int]]:
    """Byte positions to index together: any four of the eight positions hold one of these triples.

    Fingerprints that differ in four bits share four bytes at least. Turan's construction needs 20 triples: the
    positions are dealt to three parts, and a triple lies within a part or has two in one and one in the next.
    """
    part = [0, 0, 0, 1, 1, 1, 2, 2]

    def indexed(t: tuple[int, int, int]) -> bool:
        n = [sum(part[i] == p for i in t) for p in range(3)]
        return 3 in n or any(n[p] == 2 and n[(p + 1) % 3] == 1 for p in range(3))

    return [t for t in combinations(range(BYTES), 3) if indexed(t)]


def simhash(words: list[bytes], shingle: int, seed: int) -> int:
    """64-bit fingerprint: a bit is set if it is set in over half of the shingles' hashes."""
    import xxhash

    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], seed) for a, b in spans], np.uint64)
    places = h.view(np.uint8).reshape(-1, BYTES) + np.arange(0, 256 * BYTES, 256)
    seen = np.bincount(places.ravel(), minlength=256 * BYTES).reshape(BYTES, 256)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    ones = (seen @ bits.astype(np.int64)).ravel()
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """``(k, fp)``: the SimHash of the ASCII-lower-cased words of each text, as a signed long."""
    key_type = dict(docs.select(key).dtypes)[key]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(t.as_py().encode().lower().split(), shingle, seed) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["k", "fp"])

    return docs.select(F.col(key).alias("k"), whole(text).alias("t")).mapInArrow(mark, f"k {key_type}, fp long")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(member, root)`` that connect what the links ``a - b`` connect, one per member."""
    ids, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = flat[:len(a)], flat[len(a):]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while True:
            hop = new[new]
            if np.array_equal(hop, new):
                break
            new = hop
        new = new[label]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(ids))
    return ids[moved], ids[label[moved]]


def posting_links(tile: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs among rows of equal ``tile`` (sorted): tally the shared positional bytes of each pair, keep those
    with as many as the radius guarantees, and count the differing bits of these."""
    left, s = np.arange(len(tile) - 1), 0
    while len(left):
        s += 1
        left = left[left + s < len(tile)]
        left = left[tile[left] == tile[left + s]]
        differ = fp[left] ^ fp[left + s]
        shared = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
        keep = np.flatnonzero((shared >= BYTES - radius) & (differ != 0))
        keep = keep[np.bitwise_count(differ[keep]) <= radius]
        if len(keep):
            yield fp[left[keep]], fp[left[keep] + s]


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    tile, fp = np.empty(0, np.int64), np.empty(0, np.uint64)

    def reduced() -> None:
        if held:
            held[:] = [forest(*(np.concatenate(x) for x in zip(*held)))]

    def take(t: np.ndarray, f: np.ndarray) -> None:
        for pair in posting_links(t, f, radius):
            held.append(pair)
            if sum(len(x) for x, _ in held) > HELD_LINKS:
                reduced()

    for batch in batches:
        tile = np.concatenate((tile, batch.column(0).to_numpy()))
        fp = np.concatenate((fp, batch.column(1).to_numpy().view(np.uint64)))
        whole_ = np.searchsorted(tile, tile[-1]) if len(tile) and np.all(tile[:-1] <= tile[1:]) else 0
        take(tile[:whole_], fp[:whole_])
        tile, fp = tile[whole_:], fp[whole_:]
    take(tile, fp)
    reduced()
    for u, v in held:
        yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])


def near_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``(u, v)`` that connect the distinct fingerprints ``fp`` which differ in at most ``radius`` bits, four or fewer.

    Each fingerprint is posted under 20 triples of positional bytes. A posting list is compared in tiles of bounded
    size: a list of more than ``BLOCK`` rows is dealt into blocks by a hash and its pairs of blocks go to different
    tasks. A task returns a spanning forest of its links, never all pairs of a dense group.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"the index finds links of at most {RADIUS} bits, not {radius}")

    def byte(i: int) -> Column:
        return F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255).cast("long"))

    keys = [F.lit(n).cast("long") * (1 << 24) + byte(a) * 65_536 + byte(b) * 256 + byte(c)
            for n, (a, b, c) in enumerate(index_triples())]
    posted = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    lists = cut(posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-lists")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = (posted.join(lists, "key").withColumn("blocks", blocks)
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    tile = F.when(F.col("blocks") == 1, F.col("key")).otherwise(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
    dealt = dealt.select(tile.alias("tile"), "fp")
    return dealt.repartition("tile").sortWithinPartitions("tile").mapInArrow(lambda x: _links(x, radius), "u long, v long").distinct()


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = RADIUS,
                    seed: int = 42) -> DataFrame:
    """``(key, fingerprint, component_id)`` per row of ``docs``: fingerprints link at ``radius`` or fewer differing bits and
    ``component_id`` is the smallest key that can be reached.

    Documents of equal fingerprint are one vertex, so a group of copies costs one row. A text of fewer words than
    ``shingle`` is one shingle; null texts and texts without a word have fingerprint zero and link like any
    other. Rows with a null key get the component's smallest key, which is null only if none of its rows has a
    key; repeated keys keep their rows; an empty table gives an empty result. Other columns are ignored.
    """
    prepare_texts(docs.sparkSession)
    marked = cut(fingerprints(docs, key=key, text=text, shingle=shingle, seed=seed), "simhash-marks")
    fps = cut(marked.groupBy("fp").agg(F.min("k").alias("low")), "simhash-distinct")
    roots = connected_components(cut(near_links(fps, radius), "simhash-links"))
    members = fps.join(roots.withColumnRenamed("id", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = members.groupBy("root").agg(F.min("low").alias("component_id"))
    component = members.join(lowest, "root").select("fp", "component_id")
    return (marked.join(component, "fp")
            .select(F.col("k").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = RADIUS,
                seed: int = 42) -> DataFrame:
    """``docs`` with one row of each group of :func:`near_duplicates`: that of the smallest key; nulls are last.

    Keys only choose among the rows of a group: different texts with equal keys, or without one, all stay if no
    fingerprint links them. Null and empty texts and those without a word are one group. All columns of ``docs``
    pass through, whatever their names; an empty table gives an empty one.
    """
    prepare_texts(docs.sparkSession)
    rows = cut(docs.select(F.struct("*").alias("d"), F.monotonically_increasing_id().alias("row")), "simhash-rows")
    texts = rows.select("row", F.col(f"d.`{key}`").alias("k"), F.col(f"d.`{text}`").alias("t"))
    groups = near_duplicates(texts, key="row", text="t", shingle=shingle, radius=radius, seed=seed).select("row", "component_id")
    groups = cut(groups.join(texts.select("row", "k"), "row"), "simhash-groups")
    first = groups.groupBy("component_id").agg(F.min(F.struct(F.col("k").isNull().alias("none"), "k", "row")).alias("x"))
    gone = cut(groups.join(first, "component_id").where("row <> x.row").select("row"), "simhash-gone")
    few = rows_within(gone, BROADCAST_IDS) is not None
    return rows.join(F.broadcast(gone) if few else gone, "row", "left_anti").select("d.*")
