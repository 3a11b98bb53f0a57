"""Quality rules whose cutoffs are chosen with a bound on false rejections."""

from __future__ import annotations

import math
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import WORD, let, prepare_texts, quoted, whole, words_sql

#: Rules reject above a cutoff; the metric of each as SQL over the counts. Cutoffs are tried as listed.
RULES = {
    "symbols": ("n_symbols / greatest(n_words, 1L)", (0.02, 0.05, 0.1, 0.2, 0.4, 0.8)),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1L)", (0.05, 0.1, 0.2, 0.3, 0.5, 0.7)),
    "repeats": ("n_repeat_words / greatest(n_words, 1L)", (0.05, 0.1, 0.15, 0.2, 0.3, 0.4)),
    "word_length": ("word_chars / greatest(n_words, 1L)", (7.0, 8.0, 9.0, 10.0, 12.0, 15.0)),
}
MIN_WORDS, MAX_REPEATS = 50, 0.5
#: Largest share of good documents that all rules together may reject in a stratum, and the chance of a wrong promise.
ALPHA, DELTA = 0.01, 0.05
#: Part of ``DELTA`` for the cutoffs that are tested together.
JOINT = 0.8


def measures(docs: DataFrame, *, key: str, text: str, stratum: str) -> DataFrame:
    """``(k, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)`` per document.

    Repeats are found by sorting the hashes of a text's three-word windows with their places, which is
    n log n for any text; texts without a repeated window skip it.
    """
    windows = "transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))"
    ordered = "array_sort(transform(g, (h, i) -> struct(h as h, i as i)))"
    twice = "filter(o, (x, i) -> (i > 0 and o[greatest(i - 1, 0)].h = x.h) or (i + 1 < size(o) and o[least(i + 1, size(o) - 1)].h = x.h))"
    covered = ("aggregate(zip_with(slice(p, 2, size(p) - 1), slice(p, 1, size(p) - 1), (b, a) -> least(3, b - a)), 0L, (a, x) -> a + x) + 3L")
    places = let(let(ordered, "o", twice), "r", "array_sort(transform(r, x -> x.i))")
    repeats = let(windows, "g", f"if(size(array_distinct(g)) = size(g), 0L, {let(places, 'p', covered)})")
    by_words = let(words_sql("t"), "w", f"struct(cast(size(w) as long) as n_words, if(size(w) < 3, 0L, {repeats}) as n_repeat_words)")
    lines = let(f"filter(split(t, '\\n', -1), x -> x rlike {quoted(WORD)})", "l",
                "struct(cast(size(l) as long) as n_lines, cast(size(l) - size(array_distinct(l)) as long) as n_dup_lines)")
    rows = docs.select(F.col(key).alias("k"), F.col(stratum).cast("string").alias("stratum"), whole(text).alias("t"))
    return (rows.select("k", "stratum", F.expr(by_words).alias("w"), F.expr(lines).alias("l"),
                        F.expr("cast(length(t) - length(regexp_replace(t, '[^\\\\x20\\\\x09-\\\\x0D]+', '')) as long)").alias("word_chars"),
                        F.expr("cast(regexp_count(t, '[#*$%&|<>]') as long)").alias("n_symbols"))
            .select("k", "stratum", "w.*", "l.*", "word_chars", "n_symbols"))


def binomial_tail(k: str, n: str, p: float) -> str:
    """SQL for P(X <= k) with X binomial, by summing terms downwards from k < p n.

    The first term comes from Stirling's series (to 1e-10 of its logarithm), each next one from a ratio. Terms that
    lie further below the mean than forty deviations are beneath the smallest double and left out.
    """
    def lgamma(x: str) -> str:  # of x + 1; the shift by 8 makes the series exact enough at any x
        shift = " + ".join(f"ln({x} + {i})" for i in range(1, 8))
        z = f"({x} + 8)"
        return (f"(({z} - 0.5D) * ln({z}) - {z} + {0.5 * math.log(2 * math.pi)}D + 1 / (12 * {z}) - 1 / (360 * pow({z}, 3)) "
                f"+ 1 / (1260 * pow({z}, 5)) - ({shift}))")
    first = (f"exp({lgamma(k)} * -1 - {lgamma(f'({n} - {k})')} + {lgamma(n)} + {k} * ln({p}D) + ({n} - {k}) * ln({1 - p}D))")
    reach = f"cast(least({k}, ceil(40 * sqrt({n} * {p * (1 - p)}D)) + 40) as int)"
    ratio = f"a.x * ({k} - i) / ({n} - {k} + i + 1) * {(1 - p) / p}D"
    return (f"aggregate(sequence(0, {reach}), named_struct('x', {first}, 'sum', cast(0.0 as double)), "
            f"(a, i) -> named_struct('x', {ratio}, 'sum', a.sum + a.x), a -> a.sum)")


def certified_cutoffs(holdout: DataFrame, *, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``(stratum, rule, cutoff, rejected, n, p_value)``: the certified cutoffs of each stratum.

    ``holdout`` has the measures of documents known to be good. A cutoff is certified if as few false rejections as were
    seen have a probability below a level when the true share is larger (the exact Clopper-Pearson test). Cutoffs are
    tested from the loosest on and the first that fails ends its sequence, so a sequence needs one level, not one for
    each cutoff. Two families share ``delta``, and both promise at most ``alpha`` for all rules together:

    * ``JOINT`` of it goes to one sequence a stratum, in which all rules step together and the documents that any of
      them rejects are held to the whole of ``alpha``; a few hundred documents without a false rejection do.
    * The rest goes to a sequence for each rule, held to ``alpha`` / number of rules, which one noisy rule cannot stop.

    A stratum takes the family that passed more cutoffs. A rule without a certified cutoff does not act there.
    """
    share, names, steps = alpha / len(RULES), list(RULES), len(next(iter(RULES.values()))[1])
    over = {(rule, s): F.expr(metric) > cutoffs[-s] for rule, (metric, cutoffs) in RULES.items() for s in range(1, steps + 1)}
    for s in range(1, steps + 1):
        over["all", s] = reduce(or_, (over[rule, s] for rule in names))
    per = holdout.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.when(x, 1).otherwise(0)).cast("long").alias(f"{rule}_{s}") for (rule, s), x in over.items()])
    tests = [F.struct(F.lit(rule).alias("rule"), F.lit(s).alias("step"), F.col(f"{rule}_{s}").alias("rejected")) for rule, s in over]
    strata = per.agg(F.count(F.lit(1)).alias("strata"))
    rows = per.select("stratum", "n", F.explode(F.array(*tests)).alias("x")).select("stratum", "n", "x.*").crossJoin(F.broadcast(strata))
    joint = F.col("rule") == "all"

    def p_value(most: float) -> Column:
        tail = F.expr(binomial_tail("cast(rejected as double)", "cast(n as double)", most))
        return F.when(F.col("rejected") >= F.lit(most) * F.col("n"), F.lit(1.0)).otherwise(tail)

    rows = rows.withColumn("p_value", F.when(joint, p_value(alpha)).otherwise(p_value(share)))
    level = F.when(joint, F.lit(JOINT * delta)).otherwise(F.lit((1 - JOINT) * delta / len(RULES))) / F.col("strata")
    # a tighter cutoff rejects no less, so those that pass are the first of their sequence
    passed = F.struct("step", "p_value")
    per = rows.groupBy("stratum").agg(
        F.min("n").alias("n"),
        *[F.max(F.when((F.col("rule") == r) & (F.col("p_value") <= level), passed)).alias(f"own_{r}") for r in ("all", *names)],
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws("_", "rule", "step"), "rejected"))).alias("seen"))
    together = len(names) * F.coalesce("own_all.step", F.lit(0)) >= reduce(add, (F.coalesce(f"own_{r}.step", F.lit(0)) for r in names))
    found = [F.struct(F.lit(r).alias("rule"), F.array(*[F.lit(float(c)) for c in RULES[r][1]]).alias("cutoffs"),
                      F.when(together, F.col("own_all")).otherwise(F.col(f"own_{r}")).alias("x")) for r in names]
    return (per.select("stratum", "n", "seen", F.explode(F.array(*found)).alias("f")).where("f.x is not null")
            .select("stratum", "f.rule", F.element_at("f.cutoffs", -F.col("f.x.step")).alias("cutoff"),
                    F.element_at("seen", F.concat_ws("_", "f.rule", "f.x.step")).alias("rejected"), "n", "f.x.p_value"))


def apply_rules(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", stratum: str = "lang",
                label: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)`` per row of ``docs``.

    ``labels`` has ``key`` and ``label`` (1: good). A document fails the base rules with fewer than 50 words or more than
    half of its words in repeated windows; it is kept if it passes them and no certified cutoff rejects it.

    Null text counts as empty and fails; a null stratum is a stratum; labels that are null, repeated for a key or
    without a document are counted once, not at all; an empty table gives an empty result. Other columns are ignored.
    """
    prepare_texts(docs.sparkSession)
    rows = cut(measures(docs, key=key, text=text, stratum=stratum), "quality-measures").withColumn(
        "base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {int(100 * MAX_REPEATS)} * n_words"))
    good = labels.groupBy(F.col(key).alias("g")).agg(F.min(label).alias("good")).where("good = 1").select("g")
    holdout = rows.where("not base_failed").join(good, F.col("k") == F.col("g"), "left_semi")
    names = list(RULES)
    cutoffs = certified_cutoffs(holdout, alpha=alpha, delta=delta).groupBy(F.col("stratum").alias("s")).agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in names])
    rejected = F.lit(False)
    for r in names:
        rejected = rejected | F.coalesce(F.expr(RULES[r][0]) > F.col(f"cut_{r}"), F.lit(False))
    return (rows.join(cutoffs, F.col("stratum").eqNullSafe(F.col("s")), "left")
            .select(F.col("k").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & ~rejected).alias("kept")))
