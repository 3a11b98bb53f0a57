"""Result tables with keyed upserts and deletes, published by commit records.

A commit record is a small file with the next free number. It lists the folders of every table, so a state of all
tables becomes visible at once, and a run that stops before its commit changes nothing. Records are claimed by
creating their file: of two writers that started from one state the second is refused.

Tables with a ``timestamp`` are kept by day. File sources have no MERGE, so a change rewrites the days that hold
one of its keys, old or new, and leaves the folders of all other days where they are.

Records carry tags, such as a job and its reference date, and any recorded state can be read again.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut, scratch_scope
from ..settings import KEYS, TABLES

#: Column by which a table's folders are kept, so that readers with a time window skip old ones.
DAY = "timestamp"
#: Folder of the commit records.
COMMITS = "_commits"

#: Per table, the day (None for a table without days, "" for no day) and folder of each part.
State = dict[str, list[list]]


def _clean(column: Column, kind: T.DataType) -> Column:
    """NaN to NULL, inside arrays and structs too: NaN or NULL array entries are dropped."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(column), F.lit(None)).otherwise(column)
    if isinstance(kind, T.ArrayType):
        items = F.transform(column, lambda v: _clean(v, kind.elementType))
        return F.filter(items, lambda v: v.isNotNull())
    if isinstance(kind, T.StructType):
        fields = F.struct(*[_clean(column[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(column.isNotNull(), fields)
    return column


def sanitized(rows: DataFrame) -> DataFrame:
    return rows.select(*[_clean(F.col(f.name), f.dataType).alias(f.name) for f in rows.schema.fields])


def replace_rows(current: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``updates`` replace those with the same key, NULL fields included."""
    return current.join(updates.select(*keys), keys, "left_anti").unionByName(updates)


def merge_rows(current: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Partial update: fields of ``updates`` that are NULL or NaN keep the current value."""
    new = sanitized(updates)
    named = new.select(*keys, *[F.col(c).alias(f"__{c}") for c in new.columns if c not in keys], F.lit(True).alias("__u"))
    joined = current.join(named, keys, "full")
    return joined.select(*[F.col(c) if c in keys or c not in new.columns else F.coalesce(f"__{c}", c).alias(c)
                           for c in current.columns])


def delete_rows(current: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return current.join(gone.select(*keys).distinct(), keys, "left_anti")


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


class ConcurrentWrite(RuntimeError):
    """Another writer has committed since this one started."""


class Store:
    """The five result tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._open: dict | None = None

    # -- commit records ------------------------------------------------------------------------

    def _path(self, name: str):
        path = self._fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self._conf)

    def _names(self, folder: str) -> list[str]:
        path, fs = self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _record(self, number: int) -> dict | None:
        """A commit record, or None if its writer stopped before it was whole."""
        path, fs = self._path(f"{COMMITS}/{number:012d}.json")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def _numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self._names(COMMITS) if n.endswith(".json")]

    def commits(self) -> list[dict]:
        """Whole commit records, oldest first."""
        return [r for r in map(self._record, self._numbers()) if r]

    def _last(self) -> dict:
        for number in reversed(self._numbers()):
            if record := self._record(number):
                return record
        return {"number": 0, "tables": {}, "tags": []}

    def before(self, job: str, day: dt.date) -> dict | None:
        """The state that the first run of ``job`` for ``day`` found; None if there was no such run."""
        last = {"number": 0, "tables": {}, "tags": []}
        for record in self.commits():
            if [job, day.isoformat()] in record["tags"]:
                return last
            last = record
        return None

    def later(self, job: str, day: dt.date) -> list[str]:
        """Days after ``day`` for which ``job`` has run."""
        return sorted({d for r in self.commits() for j, d in r["tags"] if j == job and d > day.isoformat()})

    @contextmanager
    def transaction(self, *tags: tuple[str, dt.date], base: dict | None = None):
        """Publish all writes of the block as one commit, or none of them if the block fails.

        Reads inside the block see its writes. Tables start from the last state, those that ``base`` names
        from that recorded state.
        """
        if self._open is not None:
            raise RuntimeError("a transaction is open already")
        last = self._last()
        tables = {**last["tables"], **(base or {}).get("tables", {})}
        self._open = {"number": max([0, *self._numbers()]) + 1, "base": last["number"], "tables": tables,
                      "tags": [[job, day.isoformat()] for job, day in tags]}
        try:
            yield self
            record = self._open
        finally:
            self._open = None
        self._commit(record)

    def _commit(self, record: dict) -> None:
        if self._last()["number"] != record["base"]:
            raise ConcurrentWrite(f"commit {record['base']} is no longer the last one")
        path, fs = self._path(f"{COMMITS}/{record['number']:012d}.json")
        try:
            stream = fs.create(path, False)
        except Exception as taken:
            raise ConcurrentWrite(f"commit {record['number']} has been claimed") from taken
        try:
            stream.write(bytearray(json.dumps(record), "utf-8"))
        finally:
            stream.close()

    @contextmanager
    def _change(self):
        if self._open is not None:
            yield self._open["tables"]
        else:
            with self.transaction():
                yield self._open["tables"]

    def _tables(self) -> State:
        return (self._open or self._last())["tables"]

    # -- reading -------------------------------------------------------------------------------

    def exists(self, table: str) -> bool:
        return table in self._tables()

    def read(self, table: str, state: dict | None = None) -> DataFrame:
        """Current rows, or those of a recorded ``state``; an empty table with the right columns when there are none."""
        schema = TABLES[table]
        folders = [f for _, f in (state["tables"] if state else self._tables()).get(table, [])]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
                .parquet(*[f"{self.root}/{f}" for f in folders]).select(*schema.names))

    # -- writing -------------------------------------------------------------------------------

    def _dated(self, table: str) -> bool:
        return DAY in TABLES[table].names

    def _written(self, table: str, rows: DataFrame) -> list[list]:
        """Write rows to new folders and return their days and names."""
        schema = TABLES[table]
        folder = f"{table}/w={uuid.uuid4().hex}"
        shaped = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        if not self._dated(table):
            shaped.write.parquet(f"{self.root}/{folder}")
            return [[None, folder]]
        # rows of one day go to one task unless they are many; a huge day is split
        shaped.hint("rebalance", F.col(DAY)).write.partitionBy(DAY).parquet(f"{self.root}/{folder}")
        found = [n for n in self._names(folder) if n.startswith(f"{DAY}=")]
        return [["" if n.endswith("__") else n.partition("=")[2], f"{folder}/{n}"] for n in found]

    def write(self, table: str, rows: DataFrame) -> DataFrame:
        """Replace all rows."""
        with self._change() as tables:
            tables[table] = self._written(table, rows)
        return self.read(table)

    def create(self, table: str, reset: bool = False) -> DataFrame:
        if reset or not self.exists(table):
            return self.write(table, self.spark.createDataFrame([], TABLES[table]))
        return self.read(table)

    def _replaced(self, table: str, keys: list[str], gone: DataFrame, old: DataFrame, new: DataFrame | None) -> DataFrame:
        """Take out the rows with keys of ``gone``, which are ``old``, and put in ``new``, in the days of either."""
        with self._change() as tables:
            current = self.read(table)
            if not self._dated(table):
                kept = current.join(gone, keys, "left_anti")
                tables[table] = self._written(table, kept.unionByName(new) if new is not None else kept)
                return self.read(table)
            days = old.select(DAY) if new is None else old.select(DAY).unionByName(new.select(DAY))
            touched = {"" if r[DAY] is None else r[DAY].isoformat() for r in days.distinct().collect()}
            parts = tables.get(table, [])
            stay = [p for p in parts if p[0] not in touched]
            if touched:
                dates = [dt.date.fromisoformat(d) for d in touched if d]
                there = F.col(DAY).isin(dates) if dates else F.lit(False)
                kept = current.where(there | F.col(DAY).isNull() if "" in touched else there).join(gone, keys, "left_anti")
                tables[table] = stay + self._written(table, kept.unionByName(new) if new is not None else kept)
            elif table not in tables:
                tables[table] = []
            return self.read(table)

    def _widened(self, table: str, rows: DataFrame) -> DataFrame:
        have = set(rows.columns)
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have
                             else F.lit(None).cast(f.dataType).alias(f.name) for f in TABLES[table].fields])

    def upsert(self, table: str, updates: DataFrame) -> DataFrame:
        """Documents and links are replaced, clusters and communities partially updated."""
        keys = KEYS[table]
        change = merge_rows if table in ("clusters", "communities") else replace_rows
        with scratch_scope(self.spark):
            updates = cut(self._widened(table, updates), f"update-{table}")
            twice = repeated_keys(updates, keys).limit(1).take(1)
            if twice:
                raise ValueError(f"more than one update for {twice[0].asDict()} of {table}")
            old = cut(self.read(table).join(updates.select(*keys), keys, "left_semi"), f"old-{table}")
            new = cut(change(old, updates, keys), f"new-{table}")
            return self._replaced(table, keys, updates.select(*keys), old, new)

    def delete(self, table: str, gone: DataFrame, keys: list[str] | None = None) -> DataFrame:
        """Remove the rows with these keys; by default those of the table."""
        keys = keys or KEYS[table]
        with scratch_scope(self.spark):
            gone = cut(gone.select(*keys).distinct(), f"gone-{table}")
            return self._replaced(table, keys, gone, self.read(table).join(gone, keys, "left_semi"), None)

    def vacuum(self, keep: int = 30) -> int:
        """Remove all but the last ``keep`` commits and the folders that only they or no commit name. No writer may be
        at work, since its folders are not named yet. Returns how many folders went."""
        records = self.commits()
        named = {f for r in records[-keep:] for parts in r["tables"].values() for _, f in parts}
        removed = 0
        for table in TABLES:
            for folder in self._names(table):
                inner = [f"{table}/{folder}/{n}" for n in self._names(f"{table}/{folder}") if "=" in n] or [f"{table}/{folder}"]
                for name in [f"{table}/{folder}"] if not named.intersection(inner) else [n for n in inner if n not in named]:
                    path, fs = self._path(name)
                    fs.delete(path, True)
                    removed += 1
        for record in records[:-keep]:
            path, fs = self._path(f"{COMMITS}/{record['number']:012d}.json")
            fs.delete(path, False)
        return removed
