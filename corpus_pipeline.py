"""Corpus pipeline: clean, deduplicate, redact, mix and pack documents, one written table per stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from topicloom.llm import credentials, mixing, packing, simhash, toxicity
from topicloom.llm.common import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return staged("toxicity", lambda: toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return staged("near_duplicates", lambda: simhash.one_of_each(docs, shingle=4, radius=4), docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return staged("secrets", lambda: credentials.redact(docs), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return staged("mixing", lambda: mixing.mixed_documents(docs), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return staged("packing", lambda: packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")), docs, last=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Scores, tokens and fingerprints are beyond SQL; tests hold each stage against brute force or its operator.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each writes one table, which goes when the stage after the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
