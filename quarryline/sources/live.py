"""Live databases: tables and queries over JDBC, set-up scripts, and changes made for trials."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.plans.config import Config, ConfigError
from quarryline.sources.readers import newer_than, read_query, read_source


def table_reader(spark: SparkSession, config: Config, watermark: Callable[[str], str | None] | None = None) -> Callable[[str], DataFrame]:
    """A function that reads a source table of the configured database.

    Where an incremental load has a watermark, its bound is a filter on the
    reader, which Spark hands to the database.
    """
    if not config.source_options.get("url"):
        raise ConfigError("source_options.url names no database")

    def read(table: str) -> DataFrame:
        rows = read_source(spark, f"{config.source_schema}.{table}", "jdbc", config.source_options)
        column = config.incremental_columns.get(table) if config.load_type == "incremental" else None
        test = newer_than(column, watermark(table), config.lookback_minutes) if column and watermark else None
        return rows if test is None else rows.where(test)

    return read


def query_reader(spark: SparkSession, config: Config) -> Callable[[str], DataFrame]:
    """A function that has the database evaluate a query."""
    if not config.source_options.get("url"):
        raise ConfigError("source_options.url names no database")
    return lambda query: read_query(spark, query, config.source_options)


def statements(script: str) -> Iterator[str]:
    """The statements of a SQL script: cut at semicolons outside quotes, dollar quotes and comments."""
    held, at, size = [], 0, len(script)
    while at < size:
        two = script[at : at + 2]
        if two == "--":
            stop = script.find("\n", at)
            at = size if stop < 0 else stop
            continue
        if two == "/*":
            stop = script.find("*/", at + 2)
            at = size if stop < 0 else stop + 2
            continue
        c = script[at]
        if c == ";":
            if text := "".join(held).strip():
                yield text
            held = []
            at += 1
            continue
        stop = at + 1
        if c in "'\"":
            stop = script.find(c, at + 1) + 1 or size
        elif c == "$" and (end := script.find("$", at + 1)) > 0 and (script[at + 1 : end].isidentifier() or end == at + 1):
            tag = script[at : end + 1]
            close = script.find(tag, end + 1)
            stop = size if close < 0 else close + len(tag)
        held.append(script[at:stop])
        at = stop
    if text := "".join(held).strip():
        yield text


def run_script(spark: SparkSession, options: dict[str, str], script: str) -> int:
    """Run all statements of a script in one transaction; how many. On an error none has an effect."""
    jvm = spark.sparkContext._jvm
    if driver := options.get("driver"):
        jvm.java.lang.Class.forName(driver, True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    link = jvm.java.sql.DriverManager.getConnection(options["url"], options.get("user", ""), options.get("password", ""))
    try:
        link.setAutoCommit(False)
        done = 0
        for text in statements(script):
            statement = link.createStatement()
            try:
                statement.execute(text)
            finally:
                statement.close()
            done += 1
        link.commit()
        return done
    except Exception:
        link.rollback()
        raise
    finally:
        link.close()


def changing(rows: DataFrame, key: str, changed_at: str, round: int, touched: float = 0.05, added: float = 0.02) -> DataFrame:
    """The rows that one round of a live source inserts and touches, the same for the same round.

    Shares of the rows, chosen by a hash of key and round: touched rows keep
    their key and have a new time of change; added ones are copies with new
    keys past the greatest.
    """
    dealt = F.pmod(F.xxhash64(F.col(key), F.lit(round)), F.lit(10_000)) / 10_000
    now = F.timestamp_add("SECOND", F.lit(round), F.col(changed_at).cast("timestamp"))
    greatest = rows.agg(F.max(key)).first()[0] or 0
    old = rows.where(dealt < touched).withColumn(changed_at, now)
    new = rows.where((dealt >= touched) & (dealt < touched + added)).withColumns({key: (F.col(key) + F.lit(greatest) * (round + 1)).cast(rows.schema[key].dataType), changed_at: now})
    return old.unionByName(new)
