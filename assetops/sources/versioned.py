"""Stored tables that change in steps a stop cannot tear.

Files are never changed in place.  A change writes new folders first and then one
numbered entry of a log, which names the folders that make up the table from then
on; readers follow the newest entry.  A stop before the entry leaves files that
nobody names, a stop after it leaves folders that nobody needs, and ``vacuum``
deletes both.  An entry's number can be taken once: of two writers one finds its
number taken, reads again and repeats its step.

Entries are small JSON files (folders by partition, or ranges of keys), renamed
into place, so the file system must refuse a rename onto a file that exists.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from assetops.clock import Clock, ntz
from assetops.operators.ranking import dense_numbers
from assetops.schema import KEYS, SCHEMAS, conform


class CommitLog:
    """Numbered entries in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._spark, self._fs = spark, jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path
        self._files = self._fs.Path(path).getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        root = self._fs.Path(self.path)
        if not self._files.exists(root):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(root)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def read(self, number: int) -> dict:
        stream = self._files.open(self._fs.Path(f"{self.path}/{number:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict | None]:
        found = self.numbers()
        return (found[-1], self.read(found[-1])) if found else (-1, None)

    def commit(self, number: int, entry: dict) -> bool:
        """Takes ``number`` for ``entry``; False if it is taken."""
        draft = self._fs.Path(f"{self.path}/.{uuid.uuid4().hex}")
        target = self._fs.Path(f"{self.path}/{number:012d}.json")
        stream = self._files.create(draft)
        try:
            stream.write(json.dumps(entry).encode())
        finally:
            stream.close()
        gateway = self._spark.sparkContext._gateway
        rename = gateway.jvm.org.apache.hadoop.fs.Options.Rename
        options = gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            self._fs.FileContext.getFileContext(target.toUri(), self._conf).rename(draft, target, options)
            return True
        except Exception as e:
            if "FileAlreadyExists" not in str(e):
                raise
            self._files.delete(draft, False)
            return False


class VersionedTable:
    """Rows in one folder per partition value and version.  ``part`` gives the
    partition, a short text, of a row; partitions are few (months, buckets)."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, part: Column, order: tuple[str, ...]):
        self.spark, self.path, self.schema, self.part, self.order = spark, path, schema, part, order
        self.log = CommitLog(spark, f"{path}/log")

    def entry(self) -> dict:
        return self.log.latest()[1] or {"parts": {}, "changes": {}}

    def parts(self) -> list[str]:
        return sorted(self.entry()["parts"])

    def _dealt(self, rows: DataFrame) -> DataFrame:
        # The order columns split a partition that holds much of the table.
        keys = [F.col(c) for c in ("_part", *self.order)]
        return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def _written(self, df: DataFrame) -> dict[str, list[str]]:
        """Writes the rows below a new name; folders by partition."""
        folder = f"data-{uuid.uuid4().hex}"
        self._dealt(df.withColumn("_part", self.part)).write.partitionBy("_part").parquet(f"{self.path}/{folder}")
        found = self.log._files.listStatus(self.log._fs.Path(f"{self.path}/{folder}"))
        names = [s.getPath().getName() for s in found if s.isDirectory()]
        return {n.removeprefix("_part="): [f"{folder}/{n}"] for n in names if n.startswith("_part=")}

    def change(self, step: Callable[[dict], dict]) -> dict:
        """Repeats ``step``, from one entry to the next, until its entry is taken in."""
        while True:
            number, now = self.log.latest()
            after = step(json.loads(json.dumps(now or {"parts": {}, "changes": {}})))
            if self.log.commit(number + 1, after):
                return after

    def write(self, df: DataFrame) -> None:
        """Replaces the whole table."""
        written = self._written(df)
        self.change(lambda entry: {"parts": written, "changes": {}})

    def replace(self, rows_of: Callable[[dict], DataFrame], parts: Iterable[str], within: bool = True) -> None:
        """Replaces some partitions by the rows ``rows_of`` makes of the current
        entry.  Every row must lie in one of them, or, if not ``within``, is added
        to the partition it lies in."""
        gone = set(parts)

        def step(entry: dict) -> dict:
            written = self._written(rows_of(entry))
            if within and (strange := set(written) - gone):
                raise ValueError(f"rows of the partitions {sorted(strange)} are not replaced here")
            kept = {p: f for p, f in entry["parts"].items() if p not in gone}
            for part, folders in written.items():
                kept[part] = kept.get(part, []) + folders
            return {**entry, "parts": kept, "changes": {p: f for p, f in entry["changes"].items() if p not in gone}}

        self.change(step)

    def add(self, df: DataFrame, **noted) -> None:
        """Adds rows as changes, with what is noted in the entry."""
        self.take_in([self._written(df)], **noted)

    def take_in(self, written: list[dict[str, list[str]]], **noted) -> None:
        """Names what ``_written`` has written as changes, all in one entry."""

        def step(entry: dict) -> dict:
            for folders_by_part in written:
                for part, folders in folders_by_part.items():
                    entry["changes"].setdefault(part, []).extend(folders)
            return {**entry, **noted}

        self.change(step)

    def read(self, entry: dict, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of the named partitions, of all by default; others are not read."""
        return self._of(entry["parts"], parts, self.schema)

    def _of(self, folders: dict[str, list[str]], parts: Iterable[str] | None, schema: StructType) -> DataFrame:
        named = [f for p, some in sorted(folders.items()) if parts is None or p in set(parts) for f in some]
        if not named:
            blank = (F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields)
            return self.spark.range(1, numPartitions=1).select(*blank).where(F.lit(False))
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in named))

    def load(self, parts: Iterable[str] | None = None) -> DataFrame:
        return self.read(self.entry(), parts)

    def vacuum(self, keep: int = 1) -> int:
        """Deletes the partition folders that none of the newest ``keep`` entries
        names; their number.  Not while a writer is under way or a reader uses an
        older entry."""
        entries = [self.log.read(n) for n in self.log.numbers()[-keep:]]
        named = {f for e in entries for kind in ("parts", "changes") for some in e[kind].values() for f in some}
        fs, root, gone = self.log._files, self.log._fs.Path(self.path), 0
        for folder in fs.listStatus(root):
            name = folder.getPath().getName()
            if name.startswith("data-"):
                parts = [s.getPath() for s in fs.listStatus(folder.getPath()) if s.isDirectory()]
                unnamed = [p for p in parts if f"{name}/{p.getName()}" not in named]
                for path in unnamed if len(unnamed) < len(parts) else [folder.getPath()]:
                    fs.delete(path, True)
                gone += len(unnamed)
        return gone


# Tables that are stored by month of a date; rows without it have a month of their own.
BY_MONTH = {"maintenance": "ActualDate", "audit": "Timestamp"}
NO_MONTH = "none"


def month_of(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_MONTH))


class MonthTable(VersionedTable):
    """A canonical table, one folder per month of its date."""

    def __init__(self, spark: SparkSession, name: str, path: str):
        date = BY_MONTH[name]
        super().__init__(spark, f"{path}/{name}", SCHEMAS[name], month_of(F.col(date)), (date, KEYS[name]))
        self.name, self.date = name, date

    def write(self, df: DataFrame) -> None:
        super().write(conform(df, self.name))

    def between(self, first: str, last: str) -> DataFrame:
        """The rows of the months ``first`` to ``last`` (yyyy-MM)."""
        return self.load([m for m in self.parts() if m != NO_MONTH and first <= m <= last])

    def purge(self, clock: Clock, days: int = 180) -> list[str]:
        """Removes rows older than ``days``: whole months leave the entry, only the
        month the limit falls into is written anew.  Returns the months touched."""
        limit = clock.as_of - timedelta(days=days)
        border = limit.strftime("%Y-%m")
        touched: list[str] = []

        def step(entry: dict) -> dict:
            parts = entry["parts"]
            touched[:] = sorted(m for m in parts if m != NO_MONTH and m <= border)
            kept = {m: f for m, f in parts.items() if m not in touched}
            if border in parts:
                kept |= self._written(self.read(entry, [border]).where(F.col(self.date) >= ntz(limit)))
            return {"parts": kept, "changes": {}}

        self.change(step)
        return touched


class UpsertTable(VersionedTable):
    """A keyed table in hash buckets whose updates are stored beside it.

    ``upsert`` writes only the updates.  Readers merge them: per key the one with
    the highest ``order_by`` wins, in whatever order they were delivered.
    ``compact`` rewrites the buckets that have many of them and leaves the others'
    files alone; a row keeps the ``order_by`` of its last update, so an older one
    that comes later changes nothing.  Updates of unknown keys change nothing, as
    in an UPDATE statement."""

    APPLIED = "_applied"

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: str, updated: StructType, order_by: str, buckets: int):
        part = F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(buckets)).cast("string")
        stored = StructType([*schema.fields, StructField(self.APPLIED, updated[order_by].dataType)])
        super().__init__(spark, path, stored, part, (key,))
        self.key, self.order_by = key, order_by
        self.values = [f.name for f in updated.fields if f.name not in (key, order_by)]
        self.patches = StructType([schema[key], updated[order_by], *(updated[c] for c in self.values)])

    def write(self, df: DataFrame) -> None:
        super().write(df.withColumn(self.APPLIED, F.lit(None).cast(self.schema[self.APPLIED].dataType)))

    def upsert(self, updates: DataFrame) -> None:
        """Adds updates: the key, ``order_by`` and the new values."""
        self.add(updates.select(*self.patches.names))

    def pending(self, entry: dict, parts: Iterable[str] | None = None) -> DataFrame:
        return self._of(entry["changes"], parts, self.patches)

    def merged(self, entry: dict, parts: Iterable[str] | None = None) -> DataFrame:
        patch = F.struct(F.col(self.order_by).alias(self.APPLIED), *self.values)
        newest = self.pending(entry, parts).groupBy(self.key).agg(F.max_by(patch, self.order_by).alias("_patch"))
        applied, given = F.col(self.APPLIED), F.col(f"_patch.{self.APPLIED}")
        newer = given.isNotNull() & (applied.isNull() | (given > applied))
        return self.read(entry, parts).join(newest, self.key, "left").select(
            *(
                F.when(newer, F.col(f"_patch.{c}")).otherwise(F.col(c)).alias(c) if c in (*self.values, self.APPLIED) else c
                for c in self.schema.names
            )
        )

    def load(self, parts: Iterable[str] | None = None) -> DataFrame:
        return self.merged(self.entry(), parts).drop(self.APPLIED)

    def compact(self, least_files: int = 1) -> list[str]:
        """Merges the updates of every bucket that has ``least_files`` folders of
        them or more into its base; the buckets rewritten."""
        due = sorted(p for p, folders in self.entry()["changes"].items() if len(folders) >= least_files)
        if due:
            self.replace(lambda entry: self.merged(entry, due), due)
        return due


class CountTable(VersionedTable):
    """Counts by key.  Additions, also negative ones, are stored beside the counts
    and summed on reading; ``compact`` sums them for good."""

    def __init__(self, spark: SparkSession, path: str, keys: StructType, part: Column):
        super().__init__(spark, path, StructType([*keys.fields, StructField("n", LongType())]), part, tuple(keys.names))

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Readers sum whole buckets, so rows need no order: a bucket's rows are dealt
        by size, without a sample of what they are computed from and without a sort."""
        return rows.hint("rebalance", "_part")

    def stored(self, df: DataFrame) -> tuple[dict[str, list[str]], DataFrame]:
        """Additions written but not yet named by an entry: their folders by
        partition, for ``take_in``, and their rows."""
        written = self._written(df)
        return written, self._of(written, None, self.schema)

    def rows(self, entry: dict, parts: Iterable[str] | None = None) -> DataFrame:
        """(keys, n): counts and additions as they are stored."""
        return self.read(entry, parts).unionByName(self._of(entry["changes"], parts, self.schema))

    def counts(self, entry: dict, parts: Iterable[str] | None = None) -> DataFrame:
        """(keys, n) without zeros."""
        return self.rows(entry, parts).groupBy(*self.order).agg(F.sum("n").alias("n")).where("n <> 0")

    def load(self, parts: Iterable[str] | None = None) -> DataFrame:
        return self.counts(self.entry(), parts)

    def compact(self, least_files: int = 1) -> list[str]:
        due = sorted(p for p, folders in self.entry()["changes"].items() if len(folders) >= least_files)
        if due:
            self.replace(lambda entry: self.counts(entry, due), due)
        return due


class KeyLedger:
    """Ranges of consecutive keys, one per batch, noted before the batch's rows are
    written.  A batch that comes again gets its old range; two writers never get
    the same keys.  Every entry carries the next free key."""

    def __init__(self, spark: SparkSession, path: str):
        self.log = CommitLog(spark, path)

    def claim(self, batch: str, count: int, floor: int) -> int:
        """First key of ``batch``, above ``floor`` and every key claimed before."""
        while True:
            number, now = self.log.latest()
            # A batch comes again soon after its first time, if it does.
            for n in range(number, -1, -1):
                entry = now if n == number else self.log.read(n)
                if entry["batch"] == batch:
                    if entry["count"] != count:
                        raise ValueError(f"batch {batch} had {entry['count']} rows and comes again with {count}")
                    return entry["first"]
            first = max(floor + 1, now["first"] + now["count"] if now else 0)
            if self.log.commit(number + 1, {"batch": batch, "first": first, "count": count}):
                return first


def append_batch(ledger: KeyLedger, batch: str, new: DataFrame, key: str, order_by: str, floor: int, out_path: str) -> None:
    """Writes ``new`` with keys of its own below ``out_path``.  The order of the
    unique ``order_by`` gives each row its place in the range, so a repeated batch
    overwrites its rows with the same."""
    first = ledger.claim(batch, new.count(), floor)
    numbered = dense_numbers(new, order_by, key, start=first - 1)
    numbered.write.mode("overwrite").parquet(f"{out_path}/batch={batch}")


def highest(df: DataFrame, key: str) -> int:
    return int(df.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).first()["top"])

