"""Versioned tables over plain Parquet files.

A table is a folder with immutable data files and a log of versions. A version
lists the table's data folders and its schema; writers add a folder and then
create the next log entry, which only one of several writers can. Readers
see whole versions only, so a table can be merged from a scan of itself, and
several changes that belong together are one version.

With ``keys``, rows are stored by a hash bucket of their key, and a merge
reads and rewrites only the buckets that its source touches; the others' files
are carried over to the next version as they are. The number of buckets
follows the table's size: at first as the planner guesses it, and a merge that
finds buckets far from ``BUCKET_BYTES`` deals the table anew, which the growth
since the last time pays for. A merge's source is written once and read from
there, so that a live source cannot change between the search for its buckets
and the merge, and rows of other buckets are refused.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.sources.storage import Store

BUCKET = "_bucket"
#: Stored bytes that a bucket is meant to have, and the limits of their number.
BUCKET_BYTES = 128 << 20
LEAST_BUCKETS, MOST_BUCKETS = 8, 1 << 16


def buckets_for(size: int) -> int:
    """A power of two: so many buckets for a table of ``size`` bytes."""
    wanted = max(1, math.ceil(size / BUCKET_BYTES))
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << (wanted - 1).bit_length()))


class CommitConflict(RuntimeError):
    """Another writer created the version first."""


@dataclass
class Version:
    number: int
    operation: str
    #: Folder -> bucket, None for rows that are not bucketed.
    folders: dict[str, int | None]
    schema: str
    timestamp_ms: int
    metrics: dict = field(default_factory=dict)
    buckets: int = LEAST_BUCKETS


class SnapshotTable:
    """One table; ``buckets`` fixes their number, which else follows the size."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str] | None = None, buckets: int | None = None):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets
        self.store = Store(spark, self.path)

    # the log

    def _numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self.store.names("_log") if n.endswith(".json") and n[:-5].isdigit()]

    def _read(self, number: int) -> Version:
        return Version(**json.loads(self.store.read(f"_log/{number:010d}.json")))

    def exists(self) -> bool:
        return bool(self._numbers())

    def latest(self) -> Version | None:
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else None

    def history(self) -> list[Version]:
        return [self._read(n) for n in self._numbers()]

    def _commit(self, base: Version | None, operation: str, folders: dict[str, int | None], schema: T.StructType, metrics: dict | None = None, buckets: int | None = None) -> Version:
        number = base.number + 1 if base else 0
        new = Version(number, operation, folders, schema.json(), int(time.time() * 1000), metrics or {}, buckets or (base.buckets if base else LEAST_BUCKETS))
        if not self.store.create(f"_log/{number:010d}.json", json.dumps(asdict(new), indent=1)):
            raise CommitConflict(f"version {number} of {self.path} exists")
        return new

    # reading

    def _load(self, version: Version, buckets: set[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(version.schema))
        folders = [f"{self.path}/data/{f}" for f, b in version.folders.items() if buckets is None or b is None or b in buckets]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def read(self, number: int | None = None) -> DataFrame:
        version = self.latest() if number is None else self._read(number)
        if version is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._load(version)

    # writing

    def bucket_of(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, buckets: int) -> dict[str, int | None]:
        name = uuid.uuid4().hex
        if not self.keys:
            rows.write.parquet(f"{self.path}/data/{name}")
            return {name: None}
        dealt = rows.withColumn(BUCKET, self.bucket_of(buckets))
        # rebalancing joins small buckets' files and splits large ones over tasks
        dealt.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{name}")
        return {f"{name}/{f}": int(f.partition("=")[2]) for f in self.store.names(f"data/{name}", folders=True)}

    def _size(self, version: Version) -> int:
        return sum(self.store.size(f"data/{f}") for f in {f.partition("/")[0] for f in version.folders})

    @contextmanager
    def staged(self, rows: DataFrame) -> Iterator[DataFrame]:
        """``rows`` evaluated once: written beside the table, read from there, and deleted at the end."""
        name = f"_staging/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}")
        try:
            yield self.spark.read.schema(rows.schema).parquet(f"{self.path}/{name}")
        finally:
            self.store.delete(name)

    def overwrite(self, rows: DataFrame, operation: str = "WRITE") -> Version:
        guess = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        buckets = self.buckets or min(buckets_for(guess), 1024)  # guesses about joins are far too high
        return self._commit(self.latest(), operation, self._write(rows, buckets), rows.schema, buckets=buckets)

    def append(self, rows: DataFrame) -> Version:
        base = self.latest()
        if base is None:
            return self.overwrite(rows, "WRITE")
        schema = evolved(T.StructType.fromJson(json.loads(base.schema)), rows.schema)
        return self._commit(base, "APPEND", base.folders | self._write(conform(rows, schema), base.buckets), schema)

    def rewrite(self, change: Callable[[DataFrame], DataFrame], touched: DataFrame | None = None, operation: str = "MERGE", attempts: int = 2) -> Version:
        """Replace the table, or the buckets of ``touched``'s keys, by ``change`` of itself.

        ``change`` must keep rows of keys that ``touched`` does not hold, and
        add none; both are evaluated more than once, so they must not change
        (see :meth:`staged`).
        """
        for attempt in range(attempts):
            base = self.latest()
            if base is None:
                raise FileNotFoundError(f"no table at {self.path}")
            buckets, some = base.buckets, None
            if self.keys and not self.buckets:
                fitting = buckets_for(self._size(base))
                if not buckets / 4 < fitting < buckets * 4:
                    buckets = fitting
            if self.keys and touched is not None and buckets == base.buckets:
                # at most as many rows as there are buckets
                some = {r[0] for r in touched.select(self.bucket_of(buckets).alias(BUCKET)).distinct().collect()}
            target = self._load(base, some)
            after = change(target)
            kept = {f: b for f, b in base.folders.items() if some is not None and b not in some}
            schema = evolved(T.StructType.fromJson(json.loads(base.schema)), after.schema)
            written = self._write(conform(after, schema), buckets)
            if some is not None and (outside := set(written.values()) - some):
                raise RuntimeError(f"rows of buckets {sorted(outside)} appeared that the merge's keys do not touch; its source changed meanwhile")
            try:
                return self._commit(base, operation, kept | written, schema, {"rewritten_buckets": None if some is None else len(some)}, buckets)
            except CommitConflict:
                if attempt + 1 == attempts:
                    raise
        raise AssertionError

    def vacuum(self, keep: int = 1) -> int:
        """Delete data folders that none of the last ``keep`` versions lists; how many."""
        versions = self.history()
        used = {f.partition("/")[0] for v in versions[-keep:] for f in v.folders}
        gone = [n for n in self.store.names("data") if n not in used]
        for name in gone:
            self.store.delete(f"data/{name}")
        for v in versions[:-keep]:
            self.store.delete(f"_log/{v.number:010d}.json")
        return len(gone)


def evolved(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns in their order, then the new ones; an old column keeps its type, all allow nulls."""
    have = {f.name.lower() for f in old}
    fields = [*old, *(f for f in new if f.name.lower() not in have)]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with the schema's columns and types; missing columns are null."""
    have = {c.lower(): c for c in rows.columns}
    return rows.select(*[(F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
