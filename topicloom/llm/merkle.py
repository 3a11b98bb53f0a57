"""Document fingerprints as Merkle trees over sections, paragraphs and phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordinal import number_keys
from ..session import cut
from .common import let, prepare_texts, quoted, whole

#: A phrase ends after a space that follows punctuation or one of these letters, which depends on the content
#: next to it alone: an edit changes the phrases that it touches and no others.
PHRASE_END = r"(?<=[.,;:!?ent]\x20)"
#: Phrases and paragraphs are known by so many hexadecimal digits of their hash.
LEAF_DIGITS = 8
#: Paragraphs of one section.
SECTION = 8


def fingerprint_sql(text: str) -> str:
    """SQL for ``root;section;section...`` of a text, where a section is ``node:leaf leaf|leaf ...``.

    Lines are paragraphs, and so many paragraphs make a section. The hash of a paragraph is that of its leaves'
    hashes, the hash of a section that of its paragraphs, and the root that of its sections. Equal roots mean
    equal texts; where they differ, the sections and leaves that differ locate the edit.
    """
    leaf = f"substr(md5(x), 1, {LEAF_DIGITS})"
    paragraphs = (f"transform(split(t, '\\n', -1), p -> array_join(transform(split(p, {quoted(PHRASE_END)}, -1), x -> {leaf}), ' '))")
    section = "s -> concat(substr(sha2(s, 256), 1, 16), ':', s)"
    sections = let(paragraphs, "q", f"transform(sequence(0, cast((size(q) - 1) div {SECTION} as int)), "
                   f"i -> array_join(slice(q, i * {SECTION} + 1, {SECTION}), '|'))")
    nodes = f"transform({sections}, {section})"
    return let(text, "t", let(nodes, "n", "concat(sha2(array_join(transform(n, x -> substr(x, 1, 16)), ''), 256), ';', array_join(n, ';'))"))


def leaves(fingerprint: Column) -> Column:
    """Distinct leaf hashes of a fingerprint as 32-bit numbers."""
    bare = F.regexp_replace(fingerprint, r"^[0-9a-f]*;|[0-9a-f]{16}:", "")
    return F.array_distinct(F.transform(F.split(bare, r"[ |;]"), lambda x: (F.conv(x, 16, 10).cast("long") - F.lit(1 << 31)).cast("int")))


def likeness(a: Column, b: Column) -> Column:
    """Share of common leaves of two leaf sets (0 to 1)."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fingerprint)`` per row of ``docs``; see :func:`fingerprint_sql`. Null text counts as empty, null and
    repeated keys keep their rows, an empty table gives an empty result; other columns are ignored."""
    rows = docs.select(F.col(key).alias("k"), whole(text).alias("t"))
    return rows.select(F.col("k").alias(key), F.expr(fingerprint_sql("t")).alias("fingerprint"))


def differing(a: Column, b: Column) -> Column:
    """Numbers of the sections in which two fingerprints differ, from 0; empty for equal roots."""
    def branches(x: Column) -> Column:
        sections = F.split(x, ";")
        return F.transform(F.slice(sections, F.lit(2), F.size(sections)), lambda s: F.substring(s, 1, 16))
    pairs = F.arrays_zip(branches(a).alias("l"), branches(b).alias("r"))
    flags = F.transform(pairs, lambda p, i: F.when(p["l"].eqNullSafe(p["r"]), F.lit(-1)).otherwise(i))
    return F.when(F.substring(a, 1, 64) == F.substring(b, 1, 64), F.array().cast("array<int>")).otherwise(
        F.filter(flags, lambda i: i >= 0))


def edited_likeness(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next)`` per row of ``docs``.

    The edited text has its last quarter (rounded down) replaced by the start of the next document's text, in
    ascending ``key`` order, the first after the last. Keys are numbered by a range-partitioned sort; texts move once, in
    an exchange that both joins on the key share, and the next document sends only the asked for start of its
    text and its leaves.

    Null text counts as empty. Rows of a repeated key have the same next document, and the smallest text stands for a
    repeated next key. A null key has no place in the order, so nothing replaces its last quarter and its next
    document is empty. An empty table gives an empty result. Other columns are ignored.
    """
    prepare_texts(docs.sparkSession)
    rows = docs.select(F.col(key).alias("k"), whole(text).alias("t"))
    sizes = cut(rows.where("k is not null").groupBy("k").agg(F.max(F.length("t")).alias("n")), "merkle-sizes")
    order = cut(number_keys(sizes, ["k"], "place"), "merkle-order")
    total = order.count()
    following = order.select(F.col("k").alias("next"), F.pmod(F.col("place") - 1, F.lit(max(total, 1))).alias("place"))
    asked = (order.join(following, "place").join(sizes, "k")
             .select(F.col("k").alias("asks"), F.col("next").alias("k"), F.floor(F.col("n") / 4).cast("int").alias("m")))
    # both joins filter the texts alike, or the exchange would not be shared; rows without a key need no join
    keyed = rows.where("k is not null")
    answers = (keyed.join(asked, "k").select(F.col("asks").alias("k"), F.expr("substring(t, 1, m)").alias("start"), F.col("t"))
               .select("k", "start", leaves(F.expr(fingerprint_sql("t"))).alias("other")))
    answers = answers.groupBy("k").agg(F.min(F.struct("start", "other")).alias("a")).select("k", "a.*") if _repeats(rows, total) else answers
    cut_at = F.floor(F.length("t") / 4).cast("int")
    edited = F.concat(F.expr("substring(t, 1, length(t) - cast(floor(length(t) / 4) as int))"),
                      F.substring(F.coalesce("start", F.lit("")), F.lit(1), cut_at))
    none = leaves(F.expr(fingerprint_sql("''")))
    joined = keyed.join(answers, "k", "left").unionByName(rows.where("k is null"), allowMissingColumns=True)
    out = (joined.select("k", "t", edited.alias("edited"), F.coalesce("other", none).alias("other"))
           .withColumn("fingerprint", F.expr(fingerprint_sql("t"))).withColumn("edited_fingerprint", F.expr(fingerprint_sql("edited"))))
    own = leaves(F.col("fingerprint"))
    out = out.select("k", F.length("t").cast("long").alias("n_chars"), "edited", "fingerprint", "edited_fingerprint", own.alias("own"),
                     leaves(F.col("edited_fingerprint")).alias("changed"), "other")
    return out.select(F.col("k").alias(key), "n_chars", "edited", "fingerprint", "edited_fingerprint",
                      likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("other")).alias("near_next"))


def _repeats(rows: DataFrame, total: int) -> bool:
    return rows.where("k is not null").count() > total
