"""Session helpers: the shared scratch folder, lineage cuts and size checks."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: A broadcast side may hold at most this many rows and this many numbers; the callers
#: count before they broadcast and take a shuffle plan beyond it.
BROADCAST_ROWS = 20_000
BROADCAST_VALUES = 8_000_000

_own_scratch: dict[str, str] = {}
#: Tables of the innermost scope; each thread of the driver has its own.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def scratch_root(spark: SparkSession) -> str:
    """Folder for cut lineage: ``spark.checkpoint.dir``, or a temporary one on local masters."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_scratch:
        _own_scratch[app] = tempfile.mkdtemp(prefix="topicloom-")
    return _own_scratch[app]


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the jobs rely on: adaptive plans that split skewed join partitions even
    when the next step groups by the same key, and dates in UTC."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the scratch folder and read it back with its lineage cut.

    A written table survives the loss of executors and, unlike an eager checkpoint, runs the
    plan one time only.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/topicloom/{name}-{uuid.uuid4().hex}"
    if (tables := _scope.get()) is not None:
        tables.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the tables that :func:`cut` wrote inside the block. Nothing that leaves the block may
    read them; the jobs return their result tables."""
    mine: list[str] = []
    outer = _scope.set(mine)
    try:
        yield
    finally:
        _scope.reset(outer)
        for name in mine:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def is_empty(df: DataFrame) -> bool:
    return len(df.limit(1).take(1)) == 0


def rows_within(df: DataFrame, limit: int) -> int | None:
    """Row count when it is at most ``limit``, otherwise None (stops counting early)."""
    n = df.limit(limit + 1).count()
    return n if n <= limit else None
