"""Queries over the operators; each applies its operator to the whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import credentials, fim, merkle, minhash, mixing, negatives, packing, quality, simhash, substring, suffixes, tokens, toxicity
from .common import documents
from .oracles import ORACLES  # noqa: F401


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), window=4096, end_id=2)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: str):
        rank = list(credentials.PATTERNS).index(kind)
        return F.size(F.filter("found", lambda x: x["rank"] == rank)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda x: x["rank"] < len(credentials.BASE))
    return credentials.scan(documents(spark, sf_dir)).select(
        "doc_id", *map(count, credentials.BASE), F.sha2(credentials.joined(base), 256).alias("base_sha256"),
        credentials.joined(F.col("found")).alias("spans"), "n_live", "n_copied")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), weights=(5.0, 2.0, 1.0), limit=3.0).select(
        "doc_id", "size", "source_size", "target", "taken")


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_strings(documents(spark, sf_dir), window=50).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_toxic", "spans")


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_likeness(documents(spark, sf_dir)).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=4, radius=4, seed=42)


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"),
                               tokens.new_cache(spark), limit=4096).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op9_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeated_windows(documents(spark, sf_dir), window=13).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), anchors=F.col("vec_id") % 50 == 0, positives=5, negatives=3,
                                    low=50, high=95, scale=256)


def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transform(fim.store(documents(spark, sf_dir)), seed=7, share=100, spm_share=50))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), shingle=3, percent=85)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_secrets, op3_mixing, op4_suffixes, op5_toxicity, op6_merkle,
                               op7_simhash, op8_tokens, op9_windows, op10_quality,
                               op11_negatives, op12_middle, op13_minhash)
}
