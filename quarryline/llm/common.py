"""Shared plumbing: column picking, shared-folder tables, prefix sums, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import sys
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Bytes of an Arrow batch: texts are long, and a batch is held several times over.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started, and get batches of bounded bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # only some kinds of calls pass this setting on to their workers, so that each kind would keep workers of its own
    spark.conf.set("spark.sql.execution.pyspark.udf.simplifiedTraceback.enabled", "false")
    env = spark.sparkContext.environment
    # workers hand freed memory back: large blocks are mapped on their own, at a threshold that stays
    for name, value in {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576", "ARROW_DEFAULT_MEMORY_POOL": "system"}.items():
        env.setdefault(name, value)
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, have)])


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Only where the session names none and all of Spark is one process (tests,
    one machine) a local temporary folder is set as that folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = getattr(spark, "_quarryline_dir", None)
        if found is None:
            found = "file://" + tempfile.mkdtemp(prefix="quarryline-")
            spark._quarryline_dir = found
    return found.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder (a folder per value of ``by``) and read it back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quarryline_path = path
    sweep(spark)
    return out


#: Seconds between two sweeps, and when the last one was.
SWEEP_SECONDS = 2.0
_swept = 0.0


def sweep(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that have run, which else wait for the driver to collect its garbage."""
    global _swept
    if time.monotonic() - _swept >= SWEEP_SECONDS:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _swept = time.monotonic()


def discard(*frames: DataFrame) -> None:
    """Delete what :func:`materialize` wrote for frames that nothing reads any more."""
    for df in frames:
        delete_path(df.sparkSession, df._quarryline_path)


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select columns by exact name under new names.

    Other columns go, so that names which clash (even by case only) cannot
    make a reference ambiguous. Of columns with the same name the first counts.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    out = []
    for new, old in columns.items():
        if old not in names:
            raise ValueError(f"no column {old!r} among {names}")
        out.append(F.col(f"c{names.index(old)}").alias(new))
    return plain.select(*out)


def integer_ids(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``column`` as 64-bit integers; other kinds of ids are refused."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"ids must be integers, not {kind.simpleString()}")
    return df.withColumn(column, F.col(column).cast("long"))


def exclusive_prefix(df: DataFrame, order: str, sums: dict[str, str], span: int = 1024) -> DataFrame:
    """Add exclusive prefix sums along the integer column ``order`` (one row per value).

    Two levels: totals per ``span`` consecutive values are scanned in one
    small window (row count / ``span``), values inside a span in parallel.
    """
    block = F.floor(F.col(order) / F.lit(span))
    rows = df.withColumn("_span", block)
    totals = rows.groupBy("_span").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    before = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_span", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums])
    inside = Window.partitionBy("_span").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.join(totals, "_span")
    out = joined.withColumns({n: (F.col(f"_b_{n}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).cast("long") for n, c in sums.items()})
    return out.drop("_span", *[f"_b_{n}" for n in sums])


def spread_join(rows: DataFrame, side: DataFrame, columns: str | list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with a ``side`` of one row a value of ``columns``, also where a value has very many rows.

    A side that was aggregated by the columns would lend the join its
    partitioning, and a hot value's rows would all be one task's. A key of its
    own makes both sides exchange for the join, whose skewed partitions Spark
    then splits.
    """
    columns = [columns] if isinstance(columns, str) else columns
    key = "_quarryline_key"
    return rows.withColumn(key, F.struct(*columns)).join(side.withColumn(key, F.struct(*columns)).drop(*columns), key, how).drop(key)


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge table: rows (node, component).

    Alternating large-star and small-star contraction; every round is joins
    and grouped minima only, so no node's neighbours are gathered in a task,
    and a root with very many leaves is split over tasks. ``component`` is the
    smallest node reachable. Nodes are any ordered type. A graph that is not
    contracted after ``max_rounds`` is an error.
    """
    spark = edges.sparkSession

    def stored(pairs: DataFrame) -> tuple[str, DataFrame]:
        path = fresh_path(spark, "edges")
        pairs.write.parquet(path)
        sweep(spark)
        return path, spark.read.schema(pairs.schema).parquet(path)

    def small(pairs: DataFrame) -> DataFrame:
        """Every smaller neighbour of a node linked to the least of them."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return spread_join(pairs, least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()

    def large(pairs: DataFrame) -> DataFrame:
        """Every greater neighbour of a node linked to the least of its neighbours and itself."""
        both = pairs.select(F.col("u").alias("x"), F.col("v").alias("y")).union(pairs.select(F.col("v").alias("x"), F.col("u").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        return spread_join(both, low, "x").where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).where("u <> v")

    # a node has a link for many of the keys it shares: the first small star leaves it one
    path, current = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    for number in range(max_rounds):
        # stars: nobody has two smaller neighbours, or a smaller and a greater one
        ends = current.select(F.col("u").alias("x"), F.lit(1).alias("low"), F.lit(0).alias("high")).union(current.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("x").agg(F.sum("low").alias("low"), F.max("high").alias("high")).where("low > 1 OR (low = 1 AND high = 1)").isEmpty():
            break
        before = path
        path, current = stored(small(large(current) if number else current))
        delete_path(spark, before)
    else:
        raise RuntimeError(f"components not contracted after {max_rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def plain(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns named by position, so that none can clash, and its names."""
    names = docs.columns
    return docs.toDF(*[f"c{i}" for i in range(len(names))]), names


#: Bits of an id filter, at most 2^19 rows of one word each whatever the table's size.
FILTER_BITS = 1 << 25


class IdFilter:
    """A bitmap of hashed values of fixed size, to send few rows through a join.

    Rows whose value is not in it are certainly not among the values; the
    others may be, and an exact join decides. The more values, the more rows
    take the join. The bitmap's words are a broadcast table of at most
    ``FILTER_BITS / 64`` rows.
    """

    def __init__(self, values: DataFrame, column: str):
        bit = F.expr("shiftleft(1L, CAST(p & 63 AS INT))")
        words = values.select(self._place(F.col(column)).alias("p")).select(F.shiftright("p", 6).alias("_filter_word"), bit.alias("b"))
        self.words = materialize(words.groupBy("_filter_word").agg(F.bit_or("b").alias("_filter_bits")), "filter")

    @staticmethod
    def _place(value: F.Column) -> F.Column:
        return F.pmod(F.xxhash64(value), F.lit(FILTER_BITS)).cast("long")

    def _marked(self, rows: DataFrame, column: str) -> DataFrame:
        # the bitmap has a fixed number of rows: a proven bound
        placed = rows.withColumn("_filter_place", self._place(F.col(column))).withColumn("_filter_word", F.shiftright("_filter_place", 6))
        met = F.expr("coalesce(shiftright(_filter_bits, CAST(_filter_place & 63 AS INT)) & 1 = 1, false)")
        return placed.join(F.broadcast(self.words), "_filter_word", "left").withColumn("_filter_met", met)

    def maybe(self, rows: DataFrame, column: str) -> DataFrame:
        """Rows that may have one of the values."""
        return self._marked(rows, column).where("_filter_met").select(rows.columns)

    def split(self, rows: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
        """(rows that may have one of the values, rows that have none)."""
        return self.maybe(rows, column), self._marked(rows, column).where("NOT _filter_met").select(rows.columns)


def only(rows: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is among ``values`` (one column of that name, distinct), few of them shuffled."""
    return IdFilter(values, column).maybe(rows, column).join(values, column, "left_semi")


def without(rows: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is not among ``values``."""
    maybe, sure = IdFilter(values, column).split(rows, column)
    return sure.unionByName(maybe.join(values, column, "left_anti"))


def sliced(batches, rows: int = 1024):
    """Arrow batches in slices of a bounded number of rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def worker_cache() -> dict:
    """A dictionary that lives as long as a Python worker process."""
    return sys.__dict__.setdefault("_quarryline_worker_cache", {})


def arrow_kind(df: DataFrame, column: str):
    """The Arrow type of a column, whatever it is."""
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def release(*keep: tuple) -> None:
    """At a task's start: drop what operators before have kept in this worker, but for some keys."""
    cache = worker_cache()
    for key in [k for k in cache if k not in keep]:
        del cache[key]
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)
