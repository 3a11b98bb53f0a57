"""The corpus pipeline, stage by stage and as a whole, on the smallest tables."""

from collections import defaultdict

import pytest

import brute
import corpus_pipeline
from topicloom.llm import queries
from topicloom.session import cut


@pytest.fixture(scope="module")
def written(spark, sf):
    """Rows that each stage reads and writes, by stage name; ``documents`` for the input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = cut(stage(spark, docs, sf), f"test-{name}")
    return {name: (df.columns, [r.asDict() for r in df.collect()]) for name, df in out.items()}


def test_stages_keep_the_columns(written):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert written[name][0] == written["documents"][0]


def test_what_scores_as_toxic_goes(spark, sf, written):
    # 87 labels are too few for a good model; its accuracy is held in test_contracts
    scored = {r.doc_id: r.predicted for r in queries.op5_toxicity(spark, sf).collect()}
    clean = [r for r in written["documents"][1] if scored[r["doc_id"]] == 0]
    assert sorted(r["doc_id"] for r in written["toxicity"][1]) == sorted(r["doc_id"] for r in clean)
    before = {r["doc_id"]: r for r in clean}
    assert all(before[r["doc_id"]] == r for r in written["toxicity"][1])
    labelled = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert not [d for d, p in scored.items() if p == 1 and labelled.get(d) == 0]


def test_one_document_of_each_group_stays(written):
    rows = written["toxicity"][1]
    groups = brute.components(brute.simhashes([(r["doc_id"], r["text"]) for r in rows]))
    kept = {r["doc_id"]: r for r in rows if groups[r["doc_id"]] == r["doc_id"]}
    assert {r["doc_id"]: r for r in written["near_duplicates"][1]} == kept


def test_redaction_keeps_every_document(written):
    before = {r["doc_id"]: r for r in written["near_duplicates"][1]}
    after = {r["doc_id"]: r for r in written["secrets"][1]}
    assert before.keys() == after.keys()
    changed = [d for d in before if before[d]["text"] != after[d]["text"]]
    assert changed and all("[secret]" in after[d]["text"] for d in changed)


def test_mix_takes_whole_texts_but_one_of_a_source(written):
    texts = {r["doc_id"]: r["text"] for r in written["secrets"][1]}
    partial = defaultdict(int)
    for r in written["mixing"][1]:
        partial[r["source"]] += r["text"] != texts[r["doc_id"]]
    assert partial and max(partial.values()) <= 1


def test_packing_covers_every_row_once(written):
    pieces = written["packing"][1]
    rows, covered = defaultdict(int), defaultdict(int)
    for r in written["mixing"][1]:
        rows[r["doc_id"]] += 1
    for p in pieces:
        covered[p["doc_id"]] += p["start"] == 0
    assert rows == covered
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 4096

