"""MinHash near-duplicates against all pairs of whole sets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from topicloom.llm import minhash


def found(docs, **options):
    out = minhash.near_duplicates(docs, **options)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return out.collect()


def check(spark, rows, **options):
    want = brute.linked_sets(rows)
    got = found(spark.createDataFrame(rows, "doc_id long, text string"), **options)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)
    return want


@pytest.mark.parametrize("table", ["sf0.001", "sf0.01"])
def test_documents(spark, table):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/{table}/documents.parquet").select("doc_id", "text").collect()]
    want = check(spark, rows)
    assert len({c for _, c in want.values()}) < len(rows)


@pytest.fixture(scope="module")
def crowded():
    """Groups of edited texts of every similarity about the limit, copies, and a passage that all texts share."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for g in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([12, 40, 120, 300]))]
        for _ in range(40):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10 ** 6)}"
            texts.append(" ".join(own + passage) if g % 2 else " ".join(own).upper())
    texts += texts[:100]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block, neighbours", [(2_048, 2), (8, 1), (16, 0)])
def test_crowded_lists(spark, crowded, monkeypatch, block, neighbours):
    """Lists of many blocks; without neighbours and centres every link comes from the pairs across components."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "NEIGHBOURS", neighbours)
    if not neighbours:
        monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 1_000)
        monkeypatch.setattr(minhash, "starred", lambda lists, sets: lists.select(F.col("v").alias("a"), F.col("v").alias("b")).limit(0))
    want = check(spark, crowded)
    assert 20 < len({c for _, c in want.values()}) < 400


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One\ttwo"), (8, "one two three"), (9, long), (10, long + " tail"),
            (11, "É é"), (12, "é É"), (13, "a b c d"), (14, "\U0001f600 b"), (15, "one two three one two three one two three")]
    check(spark, rows)
    extra = [(None, "same words here and more"), (None, "same words here and more"), (7, "same words here and more"), (7, "same words here and more"),
             (3, "quite another text of words"), (3, None), (None, None), (None, "nobody else has this text")]
    docs = spark.createDataFrame([(k, t, "x", "x", 1, "x") for k, t in extra], "doc_id long, text string, row string, digest string, n int, sig string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found(docs)), key=str)
    want = [(None, 3, 7, False), (None, 3, 7, False), (7, 3, 7, True), (7, 3, 7, False), (3, 3, 3, True), (3, 0, 3, True), (None, 0, None, True), (None, 3, None, True)]
    assert got == sorted(want, key=str)
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []


def test_signature_estimates_the_similarity():
    rng = np.random.default_rng(5)
    factors, hits = minhash.multipliers(64, 42), []
    for _ in range(60):
        shared, a, b = (rng.integers(0, 1 << 64, n, np.uint64) for n in (850, 75, 75))
        x, y = (minhash.signature(np.concatenate((shared, own)), factors) for own in (a, b))
        hits.append((x == y).mean())
    assert abs(np.mean(hits) - 0.85) < 0.02


def test_signature_of_a_large_set_is_that_of_its_parts():
    h = np.random.default_rng(6).integers(0, 1 << 64, 20_000, np.uint64)
    factors = minhash.multipliers(8, 1)
    whole = minhash.signature(h, factors)
    assert (whole == minhash.signature(h[::-1].copy(), factors)).all()
    placed = factors[0] * h + factors[1]
    placed ^= placed >> np.uint64(29)
    placed *= np.uint64(0x9E3779B97F4A7C15)
    assert (whole.view(np.uint32) == h[placed.argmin(axis=1)].astype(np.uint32)).all()


def test_tasks_return_no_pairs_of_a_group(spark, monkeypatch):
    """Texts alike but below the limit: many candidate pairs, none of which leaves its task."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        own = list(base)
        for at in rng.sample(range(300), 6):
            own[at] = f"x{i}x{at}"
        rows.append((i, " ".join(own)))
    seen = {}
    kept = minhash.cut
    monkeypatch.setattr(minhash, "cut", lambda df, name: seen.setdefault(name, kept(df, name)))
    check(spark, rows)
    assert seen["minhash-rest"].count() <= len(rows) and seen["minhash-narrow"].count() <= len(rows) * minhash.COORDINATES
