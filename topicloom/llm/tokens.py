"""Token counts through a cache of content digests."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from importlib.metadata import version

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_root
from .common import prepare_texts, slices, whole

CACHE_SCHEMA = "digest string, version string, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of a tokenizer: its file and the library that reads it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        body = hashlib.sha256(f.read())
    body.update(f"{library} {version(library)}".encode())
    return body.hexdigest()


def encoder(path: str):
    """Function from texts to token numbers, without special or begin and end tokens added."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    # a task has one core; the library's own threads would compete with the other tasks
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]


def new_cache(spark: SparkSession) -> str:
    """Path of an empty cache in the shared scratch folder."""
    return f"{scratch_root(spark)}/token-cache-{uuid.uuid4().hex}"


def read_cache(spark: SparkSession, cache: str, version_: str) -> DataFrame:
    """``(digest, n_tokens)`` stored for one tokenizer version; empty if the cache was never written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest string, n_tokens long")
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("version") == version_)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, *, key: str = "doc_id", text: str = "text",
                 limit: int = 4096) -> DataFrame:
    """``(key, digest, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``.

    Texts are known by their SHA-256 digest. Digests that the cache lacks are reduced to one document each
    before any text moves, so a text with a million copies is encoded once and its copies are never gathered;
    the new counts are appended to ``cache`` (Parquet) and all documents read theirs from it. A count that two
    jobs append at the same time is equal in both, so readers take any of them.

    Null text counts as empty and has 0 tokens; null and repeated keys keep their rows; an empty table gives an
    empty result. Other columns of ``docs`` are ignored.
    """
    spark = prepare_texts(docs.sparkSession)
    version_ = tokenizer_version(tokenizer)
    rows = docs.select(F.col(key).alias("__k"), whole(text).alias("__t")).withColumn("__d", F.sha2("__t", 256))
    digests = rows.select("__k", "__d", F.octet_length("__t").cast("long").alias("n_bytes"))
    misses = (digests.groupBy("__d").agg(F.min(F.coalesce(F.col("__k").cast("string"), F.lit(""))).alias("__r"))
              .join(read_cache(spark, cache, version_).select(F.col("digest").alias("__d")), "__d", "left_anti"))
    texts = (rows.withColumn("__r", F.coalesce(F.col("__k").cast("string"), F.lit("")))
             .select("__d", "__r", "__t").join(misses, ["__d", "__r"], "left_semi").select("__d", "__t"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, seen = encoder(tokenizer), set()
        for batch in batches:
            new = {}
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if d not in seen:
                    seen.add(d)
                    new[d] = t
            keys, values = list(new), list(new.values())
            numbers = [n for a, b in slices(values) for n in count(values[a:b])]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([version_] * len(keys), pa.string()),
                                              pa.array(numbers, pa.int64())], ["digest", "version", "n_tokens"])

    texts.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    counts = read_cache(spark, cache, version_).withColumnRenamed("digest", "__d")
    return (digests.join(counts, "__d")
            .select(F.col("__k").alias(key), F.col("__d").alias("digest"), "n_bytes", "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit")))
