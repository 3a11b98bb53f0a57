"""Removal of repeated word windows: a count-min prefilter, then exact groups of what may repeat."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare_texts, settled, whole
from .repeats import Finder, covered, range_arrays, repeated_ranges, windows_in_smaller, with_ranges

#: Words of the grams that anchor a window.
GRAM = 6


def remove_repeated_windows(docs: DataFrame, *, window: int = 13, gram: int = GRAM, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_removed, kept)`` per row of ``docs``: the words that are left when every word in a window of
    ``window`` words is removed that also starts under a smaller key; ``kept`` joins them by one space.

    Merged count-min sketches over all tasks overestimate how often a window's anchor, and so the window, occurs. A
    second pass groups, exactly, only what is estimated to repeat. No repeated window is lost: its anchor is counted
    at least twice.

    Null text counts as empty, a row without a (whole-number) key is no source and stays as it is, rows of one key are
    never sources for each other, and an empty table gives an empty result. Other columns are ignored.
    """
    prepare_texts(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(key).alias("key"), whole(text).alias("t"))
    finder = Finder(rows.where("k is not null").select("k", "t"), window, gram, words=True)
    ranges = repeated_ranges(finder, lambda d: windows_in_smaller(d, window, words=True), "windows")
    parts = with_ranges(finder, rows, settled(ranges, "windows-ranges"))
    key_type = dict(docs.dtypes)[key]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept = [], [], []
            for t, r in zip(batch.column(1), range_arrays(batch.column(2))):
                words = t.as_py().encode().split()
                flags = covered(len(words), r, window)
                n.append(len(words))
                gone.append(int(flags.sum()))
                kept.append(b" ".join([w for w, f in zip(words, flags.tolist()) if not f] if gone[-1] else words).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                             ["k", "n_words", "n_removed", "kept"])

    some, none = (p.mapInArrow(keep, f"k {key_type}, n_words long, n_removed long, kept string") for p in parts)
    return some.unionByName(none).withColumnRenamed("k", key)
