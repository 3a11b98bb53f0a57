"""Small helpers of the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare, scratch_root, scratch_scope

#: Words are maximal runs of characters outside this set (space, tab to carriage return).
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


#: Size of the batches that Spark hands to Python tasks; by rows alone a batch of long texts has no bound.
BATCH_BYTES = 4_000_000


#: Row numbers that may be broadcast after they are counted (some 30 MB); beyond it the rows are shuffled.
BROADCAST_IDS = 1_000_000


def prepare_texts(spark: SparkSession) -> SparkSession:
    """Session settings of the text operators: adaptive plans, and batches of bounded size."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(text: str) -> Column:
    """The text of a document; null counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def quoted(pattern: str) -> str:
    """A regular expression as a SQL string literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``value`` bound to ``name``, evaluated once per row."""
    return f"transform(array({value}), {name} -> {body})[0]"


def words_sql(text: str) -> str:
    """SQL for the array of words of a non-null text."""
    bare = f"trim(BOTH ' \\u0009\\u000A\\u000B\\u000C\\u000D' FROM {text})"
    return let(bare, "b", f"if(b = '', cast(array() as array<string>), split(b, {quoted(SPACES)}))")


def slices(texts: list[str], size: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``size`` characters each; a longer text is a range of its own."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield first, i
            first, held = i, 0
        held += len(t)
    if first < len(texts):
        yield first, len(texts)


def settled(df: DataFrame, name: str) -> DataFrame:
    """Like :func:`cut`, for a table that outlives the scratch scope in which it is written."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/topicloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: By application, names and tables of the stages so far.
_stages: dict[str, list[tuple[str, str]]] = {}


def staged(name: str, make: Callable[[], DataFrame], docs: DataFrame, last: bool = False) -> DataFrame:
    """The result of one stage over ``docs`` as a written table.

    What the stage writes besides goes when its table is complete. When a stage begins, the tables of other stages go
    that ``docs`` does not read: its input has been written anew by then. An application runs one pipeline at a time;
    the table of the ``last`` stage stays.
    """
    spark = docs.sparkSession
    tables = _stages.setdefault(spark.sparkContext.applicationId, [])
    read = docs.inputFiles()
    for stage, path in list(tables):
        if stage != name and not any(f"/{path.rsplit('/', 1)[1]}/" in f for f in read):
            old = spark._jvm.org.apache.hadoop.fs.Path(path)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
            tables.remove((stage, path))
    path = f"{scratch_root(spark)}/topicloom/stage-{name}-{uuid.uuid4().hex}"
    with scratch_scope(spark):
        found = make()
        found.write.parquet(path)
    if not last:
        tables.append((name, path))
    return spark.read.schema(found.schema).parquet(path)
