"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare_texts, slices, whole

#: Labelled documents that the model is fitted on at most, drawn by a hash of their key.
SAMPLE_DOCS = 6_000
#: Chains of the sample that the field is fitted on at most, with and without a marked token.
SAMPLE_CHAINS = 5_000
#: Tokens of one chain; a text is cut into chains and covered to its end.
CHAIN = 64
#: Lengths of the word beginnings that are features beside the whole word.
STEMS = (3, 4, 5, 6, 7, 8)
#: Standard errors and log-odds from which a feature marks tokens of toxic documents as toxic.
MIN_ERRORS, MIN_RATIO = 4.5, 2.5
#: Words whose weight a task remembers before it starts anew.
CACHED_WORDS = 500_000
#: Marginal from which a token belongs to a reported span.
SPAN_AT = 0.5
TOKEN = r"[^\W\d_]+"


@dataclass
class Model:
    """Weights of the field (label 1 against 0 by feature) and of the document score."""

    words: dict[str, float]
    other: float
    start: np.ndarray
    steps: np.ndarray
    score: np.ndarray


def tokens(text: str) -> list[str]:
    return [w.lower() for w in re.findall(TOKEN, text)]


def features(word: str) -> list[str]:
    """A word and its beginnings, which inflected or compounded forms share."""
    return [word, *(f"{word[:n]}*" for n in STEMS if n <= len(word))]


class Weights(dict):
    """Weight of label 1 by word, filled as words are met."""

    def __init__(self, by_feature: dict[str, float], other: float):
        self.by_feature, self.other = by_feature, other

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        get = self.by_feature.get
        value = self[word] = self.other + sum(get(f, 0.0) for f in features(word))
        return value


def chains(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each token when documents of these lengths are cut into chains."""
    rows = -(-lengths // CHAIN)
    first = np.repeat(np.cumsum(rows) - rows, lengths)
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return first + at // CHAIN, at % CHAIN


def marginals(emit: np.ndarray, held: np.ndarray, start: np.ndarray, steps: np.ndarray,
              pairs: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Forward-backward over all chains at once: P(label 1) per token and, if asked for, P(label, next label) per step.

    ``emit`` (chains x CHAIN) holds the weight of label 1, ``held`` marks tokens; chains fill from the left.
    """
    n, width = emit.shape
    shift = np.exp(steps - steps.max())
    e = np.stack((np.exp(-np.logaddexp(0, emit)), np.exp(-np.logaddexp(0, -emit))), axis=2)
    e[~held] = 1.0
    fore, back = np.empty((n, width, 2)), np.ones((n, width, 2))
    a = np.exp(start - start.max()) * e[:, 0]
    fore[:, 0] = a / a.sum(axis=1, keepdims=True)
    for t in range(1, width):
        a = np.where(held[:, t, None], (fore[:, t - 1] @ shift) * e[:, t], fore[:, t - 1])
        fore[:, t] = a / a.sum(axis=1, keepdims=True)
    for t in range(width - 2, -1, -1):
        b = np.where(held[:, t + 1, None], (back[:, t + 1] * e[:, t + 1]) @ shift.T, 1.0)
        back[:, t] = b / b.sum(axis=1, keepdims=True)
    both = fore * back
    one = both[:, :, 1] / both.sum(axis=2)
    if not pairs:
        return np.where(held, one, 0.0), None
    pair = fore[:, :-1, :, None] * shift * (e[:, 1:] * back[:, 1:])[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    return np.where(held, one, 0.0), pair * held[:, 1:, None, None]


def token_labels(docs: list[np.ndarray], words: list[str], toxic: np.ndarray) -> list[str]:
    """Features whose tokens count as toxic in toxic documents.

    A feature is one if its share of documents is larger among the toxic ones by far more than chance (log-odds ratio
    with half a count added); a beginning adds nothing where the same documents have a longer marked one.
    """
    bad, good = Counter(), Counter()
    for d, y in zip(docs, toxic.tolist()):
        (bad if y else good).update({f for i in np.unique(d).tolist() for f in features(words[i])})
    n1, n0 = int(toxic.sum()), int((toxic == 0).sum())
    marked = []
    for f, k in bad.items():
        if k < 3:
            continue
        a, b = k + 0.5, good[f] + 0.5
        ratio = np.log(a / (n1 - k + 0.5)) - np.log(b / (n0 - good[f] + 0.5))
        if ratio > MIN_RATIO and ratio > MIN_ERRORS * np.sqrt(1 / a + 1 / b):
            marked.append(f)
    return sorted(marked)


def fit_chains(x: np.ndarray, table: np.ndarray, y: np.ndarray, held: np.ndarray, *, rounds: int = 80, ridge: float = 0.02):
    """Maximum likelihood with a ridge, by Adam on the sample: feature weights, start and step weights.

    ``x`` holds classes of words with equal features and ``table`` (classes x features) which ones these are.
    """
    word, start, steps = np.zeros(table.shape[1]), np.zeros(2), np.zeros((2, 2))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (word, start, steps)]
    onward = held[:, 1:]
    at = y[:, :-1] * 2 + y[:, 1:]
    seen_steps = np.bincount(at[onward], minlength=4).reshape(2, 2).astype(float)
    seen_start = np.bincount(y[:, 0], minlength=2).astype(float)
    for r in range(1, rounds + 1):
        one, pair = marginals((table @ word)[x], held, start, steps)
        g_word = np.bincount(x[held], weights=(y - one)[held], minlength=len(table)) @ table - ridge * word
        first = one[:, 0].sum()
        g_start = seen_start - np.array([len(x) - first, first]) - ridge * start
        g_steps = seen_steps - pair.sum(axis=(0, 1)) - ridge * steps
        for p, g, s in zip((word, start, steps), (g_word, g_start, g_steps), state):
            s[0] = 0.9 * s[0] + 0.1 * g
            s[1] = 0.99 * s[1] + 0.01 * g * g
            p += 0.2 * (s[0] / (1 - 0.9 ** r)) / (np.sqrt(s[1] / (1 - 0.99 ** r)) + 1e-8)
    return word, start, steps


def summaries(one: np.ndarray, rows: np.ndarray, cols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per document: log(1 + expected toxic tokens), largest marginal, square root and logarithm of the toxic share."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    p = one[rows, cols]
    total = np.bincount(doc, weights=p, minlength=len(lengths))
    top = np.zeros(len(lengths))
    np.maximum.at(top, doc, p)
    share = total / np.maximum(lengths, 1)
    return np.stack((np.log1p(total), top, np.sqrt(share), np.log(share + 1e-4) + 9, np.ones(len(lengths))), axis=1)


def fit_score(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w, penalty = np.zeros(x.shape[1]), ridge * np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
    return w


def train(texts: list[str], toxic: np.ndarray) -> Model:
    """Fit the field on labelled tokens and the score on its marginals. Without documents of both labels every
    text scores the share of toxic ones (a quarter for none)."""
    rate = (toxic.sum() + 0.5) / (len(toxic) + 2)
    if not len(toxic) or toxic.min() == toxic.max():
        return Model({}, 0.0, np.zeros(2), np.zeros((2, 2)), np.array([0.0, 0.0, 0.0, 0.0, np.log(rate / (1 - rate))]))
    numbers: dict[str, int] = {}
    docs = [np.array([numbers.setdefault(w, len(numbers)) for w in tokens(t)], np.int32) for t in texts]
    words = list(numbers)
    marked = token_labels(docs, words, toxic)
    # words of equal marked features are one class; class 0 has none
    place = {f: i for i, f in enumerate(marked)}
    classes: dict[tuple[int, ...], int] = {(): 0}
    kind = np.array([classes.setdefault(tuple(place[f] for f in features(w) if f in place), len(classes)) for w in words], np.int32)
    table = np.zeros((len(classes), len(marked) + 1))
    table[:, -1] = 1.0
    for own, c in classes.items():
        table[c, list(own)] = 1.0
    lengths = np.array([len(d) for d in docs])
    rows, cols = chains(lengths)
    n = int((-(-lengths // CHAIN)).sum())
    x, y, held = np.zeros((n, CHAIN), np.int32), np.zeros((n, CHAIN), np.int8), np.zeros((n, CHAIN), bool)
    flat = kind[np.concatenate(docs)]
    x[rows, cols] = flat
    y[rows, cols] = (flat > 0) & (np.repeat(toxic, lengths) == 1)
    held[rows, cols] = True
    # chains with a marked token and as many others, evenly spread
    marked_chain = (x > 0).any(axis=1)
    some = [np.flatnonzero(m) for m in (marked_chain, ~marked_chain)]
    use = np.unique(np.concatenate([c[np.linspace(0, len(c) - 1, min(len(c), SAMPLE_CHAINS)).astype(int)] for c in some if len(c)]))
    word, start, steps = fit_chains(x[use], table, y[use].astype(np.int64), held[use])
    one = np.concatenate([marginals((table @ word)[x[i:i + 4_000]], held[i:i + 4_000], start, steps, pairs=False)[0] for i in range(0, n, 4_000)]
                         or [np.zeros((0, CHAIN))])
    score = fit_score(summaries(one, rows, cols, lengths), toxic)
    return Model(dict(zip(marked, word[:-1].tolist())), float(word[-1]), start, steps, score)


def held_out(key: Column) -> Column:
    """Rows that are never learnt from: crc32 of the key as text is a multiple of 5; so are rows without a key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE_DOCS) -> Model:
    """Model from at most ``sample`` labelled documents that are not held out. The draw is by a hash of the key; a key
    labelled twice counts as toxic if one label says so, null labels are left out."""
    chosen = (labels.where(F.col(label).isNotNull() & ~held_out(F.col(key))).groupBy(F.col(key).alias("k"))
              .agg(F.max(label).alias("y")).join(docs.select(F.col(key).alias("k")).distinct(), "k", "left_semi")
              .orderBy(F.xxhash64("k"), "k").limit(sample))
    rows = (docs.select(F.col(key).alias("k"), whole(text).alias("t")).join(F.broadcast(chosen), "k")
            .dropDuplicates(["k"]).select("k", "t", "y").toPandas().sort_values("k"))
    return train(rows["t"].tolist(), rows["y"].to_numpy(np.int64))


def score(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, score, n_toxic, spans)`` per row of ``docs``; spans are ``(start, end)`` in code points, end exclusive.

    Nothing but the text enters a score. Null text counts as empty; a text without a word scores as one without a
    toxic token. Null and repeated keys keep their rows; an empty table gives an empty result.
    """
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([T.StructField("k", docs.schema[key].dataType), T.StructField("score", T.DoubleType()),
                           T.StructField("n_toxic", T.DoubleType()), T.StructField("spans", T.ArrayType(span))])
    # plain values: executors need not have this package to read a broadcast
    shared = docs.sparkSession.sparkContext.broadcast((model.words, model.other, model.start, model.steps, model.score))
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def located(text_: str, p: np.ndarray) -> list[dict]:
        out: list[dict] = []
        last = -2
        for i, m in enumerate(re.finditer(TOKEN, text_)):
            if p[i] >= SPAN_AT:
                if last == i - 1:
                    out[-1]["end"] = m.end()
                else:
                    out.append({"start": m.start(), "end": m.end()})
                last = i
        return out

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, other, start, steps, weights = shared.value
        weight = Weights(words, other)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            values, counts, spans = np.empty(len(texts)), np.empty(len(texts)), []
            for a, b in slices(texts):
                found = [tokens(t) for t in texts[a:b]]
                lengths = np.array([len(x) for x in found])
                rows, cols = chains(lengths)
                n = int((-(-lengths // CHAIN)).sum())
                emit, held = np.zeros((n, CHAIN)), np.zeros((n, CHAIN), bool)
                emit[rows, cols] = [weight[w] for x in found for w in x]
                held[rows, cols] = True
                one, _ = marginals(emit, held, start, steps, pairs=False)
                z = summaries(one, rows, cols, lengths)
                values[a:b] = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
                p = one[rows, cols]
                ends = np.cumsum(lengths)
                for t, q in zip(texts[a:b], np.split(p, ends[:-1])):
                    spans.append(located(t, q) if len(q) and q.max() >= SPAN_AT else [])
                counts[a:b] = np.expm1(z[:, 0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values), pa.array(counts), pa.array(spans, spans_type)],
                                             ["k", "score", "n_toxic", "spans"])

    return (docs.select(F.col(key).alias("k"), whole(text).alias("t"))
            .mapInArrow(rate, schema)
            .withColumnRenamed("k", key))


def keep_clean(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", at: float = 0.5) -> DataFrame:
    """``docs`` without the documents that score ``at`` or more. Its columns stay; see
    :func:`score` for nulls, repeats and empty texts."""
    prepare_texts(docs.sparkSession)
    model = fit(docs, labels, key=key, text=text)
    # rows pass through the scoring tasks as they are, which needs no join
    whole_rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("k"), F.col(text).alias("t"))
    return score(whole_rows, model, key="k", text="t").where(F.col("score") < at).select("k.*")
