"""First-fit decreasing packing of token sequences in randomised groups."""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import prepare_texts, whole

#: Pieces that one group holds on average; a group is packed by one task.
GROUP_PIECES = 8_192
#: Bytes of words and ids, with some for each entry, beyond which a worker forgets them before its next batch.
CACHED_BYTES, ENTRY_BYTES = 130_000_000, 180
#: Words handed to the tokenizer at a time, and words whose ids are laid out at a time.
ENCODE_WORDS, LAID_WORDS = 2_000, 1_000_000
#: Marks that the tokenizer cuts off behind a letter; ``|`` may belong to a special token.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{}~"


class Cache(dict):
    """Ids by word, of bounded size."""

    held = 0

    def trim(self) -> None:
        if self.held > CACHED_BYTES:
            self.clear()
            self.held = 0

    def remember(self, entries: dict[str, bytes]) -> None:
        self.held += sum(map(len, entries)) + sum(map(len, entries.values())) + ENTRY_BYTES * len(entries)
        self.update(entries)


class Ragged:
    """Rows of token ids of any length."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray):
        self.flat, self.lengths = flat, lengths
        self.starts = np.cumsum(lengths) - lengths

    def take(self, rows: np.ndarray) -> Ragged:
        """The rows of these numbers, in turn."""
        lengths = self.lengths[rows]
        before = np.cumsum(lengths) - lengths
        at = np.arange(int(lengths.sum())) + np.repeat(self.starts[rows] - before, lengths)
        return Ragged(self.flat[at], lengths)


class WordIds:
    """Token ids of texts.

    The tokenizer drops white space and no token crosses it, so a text's ids are those of its words in turn, and a
    batch needs the ids of its distinct words only. Lower case and closing marks after a letter are split off before
    the tokenizer is asked, because it lower-cases and cuts there as well; words with a ``|`` may hold a special
    token and go whole. What is left of letters alone is encoded many words at a time, since its last token says
    where a word ends. A worker remembers what it has asked, over all its tasks.
    """

    def __init__(self, path: str):
        # a task has one core; the library's own threads would compete with the other tasks
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        kept = sys.modules.setdefault("topicloom_worker", types.ModuleType("topicloom_worker")).__dict__
        self.known: Cache = kept.setdefault(("words", path), Cache())
        self.last = np.zeros(self.model.get_vocab_size() + 1, bool)
        for token, i in self.model.get_vocab().items():
            self.last[i] = token.endswith("</w>")

    def _one_by_one(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.model.encode_batch_fast(words, add_special_tokens=False)]

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters alone, each of which ends with its only token that ends a word."""
        ids = np.array(self.model.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
        if len(ends) != len(words):
            return self._one_by_one(words)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def lookup(self, words: pa.Array, letters: pa.Array | None = None) -> Ragged:
        """Ids of distinct words; new ones are asked for, those of ``letters`` alone together."""
        names = words.to_pylist()
        found = list(map(self.known.get, names))
        new = [i for i, x in enumerate(found) if x is None]
        alone = [False] * len(names) if letters is None else letters.to_pylist()
        for group, encode in (([i for i in new if alone[i]], self._joined), ([i for i in new if not alone[i]], self._one_by_one)):
            for at in range(0, len(group), ENCODE_WORDS):
                part = group[at:at + ENCODE_WORDS]
                ids = encode([names[i] for i in part])
                for i, x in zip(part, ids):
                    found[i] = x
                self.known.remember({names[i]: x for i, x in zip(part, ids)})
        return Ragged(np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4)

    def of_words(self, words: pa.Array) -> Ragged:
        """Ids of distinct words: those of what is left of each without its closing marks, then those of the marks."""
        bare = pc.utf8_rtrim(words, MARKS)
        # letters that the tokenizer's normal form or lower case would give a mark of their own stay with what follows
        steady = pa.array([w.isascii() or is_normalized("NFC", w) and "\u0130" not in w for w in bare.to_pylist()], pa.bool_())
        alone = pc.and_(pc.utf8_is_alpha(bare), steady)
        core = pc.if_else(alone, bare, words)
        lower = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(core, "|")))
        core = pc.if_else(lower, pc.ascii_lower(core), core).dictionary_encode()
        marks = pc.if_else(alone, pc.replace_substring_regex(words, r"^\pL+", ""), "").dictionary_encode()
        left = self.lookup(core.dictionary, pc.utf8_is_alpha(core.dictionary)).take(core.indices.to_numpy())
        right = self.lookup(marks.dictionary).take(marks.indices.to_numpy())
        n = len(words)
        both = Ragged(np.concatenate((left.flat, right.flat)), np.concatenate((left.lengths, right.lengths)))
        return Ragged(both.take(np.arange(2 * n).reshape(2, n).T.ravel()).flat, left.lengths + right.lengths)

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text."""
        self.known.trim()
        split = pc.ascii_split_whitespace(texts)
        each = split.flatten().dictionary_encode()
        words, codes = self.of_words(each.dictionary), each.indices.to_numpy()
        laid = [words.take(codes[i:i + LAID_WORDS]).flat for i in range(0, len(codes), LAID_WORDS)]
        ids = np.concatenate(laid) if laid else words.flat
        ends = np.concatenate(([0], np.cumsum(words.lengths[codes])))[split.offsets.to_numpy() - split.offsets[0].as_py()].tolist()
        for start, end in zip(ends, ends[1:]):
            yield ids[start:end]


def token_pieces(docs: DataFrame, tokenizer: str, *, window: int, end_id: int, key: str, text: str) -> DataFrame:
    """``(key, start, length, ids_crc32, doc_tokens)``: each document's ids, with ``end_id`` at the end, cut into
    pieces of at most ``window``."""
    key_type = dict(docs.select(key).dtypes)[key]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = WordIds(tokenizer), np.array([end_id], "<u4")
        step = 4 * window
        for batch in batches:
            row, start, length, crc, total = [], [], [], [], []
            for i, own in enumerate(ids(batch.column(1))):
                body = np.concatenate((own, end)).tobytes()
                n = len(body) // 4
                for at in range(0, len(body), step):
                    piece = body[at:at + step]
                    row.append(i)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
                ["__k", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col(key).alias("__k"), whole(text).alias("__t")).mapInArrow(
        split, f"__k {key_type}, start long, length long, ids_crc32 long, doc_tokens long")


def first_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, in the given order, which must be descending.

    The leaves of a complete binary tree hold the room left in each bin and inner nodes the larger room below
    them, as in a tournament: the first bin with enough room is found by walking down from the root.
    """
    n = len(lengths)
    leaves = 1 << max(0, int(n - 1).bit_length())
    tree = [window] * (2 * leaves)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for i, need in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, window - tree[node]
        tree[node] -= need
        while node > 1:
            node >>= 1
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def pack(docs: DataFrame, tokenizer: str, *, window: int = 4096, end_id: int = 2, seed: int = 17,
         group_pieces: int = GROUP_PIECES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` per piece of a document.

    Pieces are dealt to groups by a seeded hash, so that a group is a fair mixture of lengths and of bounded size
    whatever the input's order, and each group is packed by first-fit decreasing. A group leaves about one
    sequence that is not full. Sequence numbers hold the group in their upper 32 bits; offsets in a sequence
    follow each other without gaps.

    Null text counts as empty: the document is its ``end_id`` alone. Rows with null or repeated keys are packed
    like any other, each in its own right; an empty table gives no pieces. Other columns are ignored.
    """
    spark = prepare_texts(docs.sparkSession)
    pieces = token_pieces(docs, tokenizer, window=window, end_id=end_id, key=key, text=text)
    pieces = cut(pieces.withColumn("__n", F.monotonically_increasing_id()), "pack-pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    # numbered, since rows alike in all columns would meet in one group
    draw = F.xxhash64("__k", "start", "ids_crc32", "__n", F.lit(seed))
    dealt = pieces.withColumn("__g", F.pmod(draw, F.lit(groups))).drop("__n")

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "__k", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), window)
        group["sequence_id"], group["offset"] = (group["__g"].to_numpy(np.int64) << 32) + bins, offsets
        return group

    schema = ", ".join(f"{n} {t}" for n, t in dealt.dtypes) + ", sequence_id long, offset long"
    return (dealt.groupBy("__g").applyInPandas(place, schema).drop("__g").withColumnRenamed("__k", key))
