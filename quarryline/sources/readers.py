"""Readers: full and watermark-bounded tables, streams of change messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.sources.storage import store_of

#: Columns of a change message, as a message broker delivers them.
MESSAGE_SCHEMA = "topic string, partition long, offset long, timestamp timestamp, key string, value string"


def read_source(spark: SparkSession, location: str, form: str = "parquet", options: dict[str, str] | None = None) -> DataFrame:
    """A source table: files of a format, or a database table through ``jdbc`` with its options."""
    if form == "jdbc":
        return spark.read.format("jdbc").options(**(options or {})).option("dbtable", location).load()
    return spark.read.format(form).options(**(options or {})).load(location)


def read_query(spark: SparkSession, query: str, options: dict[str, str]) -> DataFrame:
    """A query that the database evaluates."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def newer_than(column: str, watermark: str | None, lookback_minutes: int) -> Column | None:
    """Rows strictly after the watermark less the lookback; None without a watermark."""
    if watermark is None:
        return None
    bound = F.lit(watermark).cast("timestamp") - F.make_dt_interval(mins=F.lit(lookback_minutes))
    return F.col(column).cast("timestamp") > bound


def incremental(rows: DataFrame, column: str | None, watermark: str | None, lookback_minutes: int = 60) -> DataFrame:
    """The rows to load: all, or those past the watermark, a filter that reaches the scan."""
    test = newer_than(column, watermark, lookback_minutes) if column else None
    return rows if test is None else rows.where(test)


class Watermarks:
    """Highest value loaded of each table's incremental column, as texts in a JSON file beside the tables."""

    def __init__(self, path: str, spark: SparkSession | None = None):
        self.store, self.name = store_of(path, spark)

    def all(self) -> dict[str, str]:
        return self.store.read_json(self.name, {})

    def get(self, table: str) -> str | None:
        return self.all().get(table)

    def put(self, table: str, value: str | None) -> None:
        if value is not None:
            self.store.replace_json(self.name, self.all() | {table: value})

    def advance(self, table: str, loaded: DataFrame, column: str) -> None:
        """From rows that are committed, so that none can slip between load and maximum."""
        self.put(table, loaded.agg(F.max(F.col(column).cast("timestamp")).cast("string")).first()[0])


def message_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of message files; the stand-in for a broker where none is installed."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def broker_stream(spark: SparkSession, servers: str, topics: list[str], starting: str = "earliest") -> DataFrame:
    """A stream of a message broker's topics, with the broker's connector installed."""
    if not servers or not topics:
        raise ValueError("a broker stream needs servers and topics")
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics)).option("startingOffsets", starting).option("failOnDataLoss", "false").load()


def table_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An append-only folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def bootstrap_log(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty log, so that readers can start before writers."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        spark.createDataFrame([], schema).write.parquet(path)


def layer_reader(spark: SparkSession, base: str, layer: str) -> Callable[[str], DataFrame]:
    """A function that reads the latest version of a layer's table."""
    from quarryline.sources.snapshot import SnapshotTable

    return lambda table: SnapshotTable(spark, f"{base}/{layer}/{table}").read()
