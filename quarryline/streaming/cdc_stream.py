"""Change streams: messages to the event log and dead letters, and on to Silver and Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from quarryline.operators import cdc
from quarryline.operators.ledger import Ledger
from quarryline.operators.schema_registry import SchemaRegistry
from quarryline.plans.batch import Metrics, bronze_table
from quarryline.plans.config import Config
from quarryline.plans.incremental import refresh
from quarryline.sources.readers import bootstrap_log, table_stream
from quarryline.sources.snapshot import SnapshotTable


def event_columns(messages: DataFrame, tables: list[str]) -> DataFrame:
    """Messages as validated events, in the log's columns."""
    events = cdc.validated(cdc.parsed(cdc.normalized(messages)), tables)
    return events.select(*cdc.log_schema().fieldNames())


def _trigger(writer, once: bool, seconds: int):
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{seconds} seconds")


def start_bronze(spark: SparkSession, config: Config, messages: DataFrame, checkpoints: str, once: bool = True) -> list[StreamingQuery]:
    """Two append-only queries with a checkpoint each: the event log and the dead letters."""
    good, bad = cdc.routed(event_columns(messages, config.tables))
    out = []
    for rows, name in ((good, "cdc_events"), (bad, "cdc_dead_letters")):
        writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{checkpoints}/{name}").option("path", config.path("bronze", name))
        out.append(_trigger(writer, once, config.trigger_seconds).start())
    return out


def apply_batch(spark: SparkSession, config: Config, events: DataFrame, registry: SchemaRegistry) -> None:
    """Merge one batch into Bronze and Silver, table by table in the configured order, then Gold.

    One grouped count says which tables the batch holds. Schemas are
    registered after their table's merges are committed.
    """
    present = {r[0] for r in events.where("is_valid_event").select("table_name").distinct().collect()}
    for table in (t for t in config.tables if t in present):
        keys = config.primary_keys[table]
        bronze, silver = bronze_table(spark, config, table), SnapshotTable(spark, config.path("silver", table), keys)
        if not bronze.exists() or not silver.exists():
            raise FileNotFoundError(f"{table} must be loaded before its changes")
        own = events.where((F.col("table_name") == table) & F.col("is_valid_event"))
        schema = registry.resolve(table, own)
        rows = cdc.record_rows(events, table, keys, schema).persist()
        try:
            touched = cdc.aligned(rows, bronze.read().schema).select(*keys)
            bronze.rewrite(lambda b, rows=rows, keys=keys, table=table, silver=silver: cdc.apply_changes(rows, b, silver.read(), table, keys, config.hard_deletes).bronze, touched)
            silver.rewrite(lambda s, rows=rows, keys=keys, table=table, bronze=bronze: cdc.apply_changes(rows, bronze.read(), s, table, keys, config.hard_deletes).silver, cdc.aligned(rows, silver.read().schema).select(*keys))
        finally:
            rows.unpersist()
        registry.register(table, schema, keys)


def start_silver(spark: SparkSession, config: Config, checkpoints: str, registry: SchemaRegistry, gold: bool = True, once: bool = True) -> StreamingQuery:
    """The event log as a stream; each batch runs once by the ledger, however often it is replayed."""
    schema = cdc.log_schema()
    bootstrap_log(spark, config.path("bronze", "cdc_events"), schema)
    ledger = Ledger(spark, config.path("_control", "").rstrip("/"))

    def each(events: DataFrame, batch_id: int) -> None:
        events = events.persist()
        try:

            def work(rows: DataFrame) -> None:
                apply_batch(spark, config, rows, registry)
                if gold:
                    refresh(spark, config.base_path, rows)

            ledger.process(events, batch_id, work)
        finally:
            events.unpersist()

    writer = table_stream(spark, config.path("bronze", "cdc_events"), schema).writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoints}/silver")
    return _trigger(writer, once, config.trigger_seconds).start()


def run_stream(spark: SparkSession, config: Config, messages: DataFrame, checkpoints: str, registry: SchemaRegistry, silver: bool = True, gold: bool = True) -> None:
    """All messages that are there, through all layers."""
    if gold and not silver:
        raise ValueError("Gold needs Silver")
    for q in start_bronze(spark, config, messages, checkpoints):
        q.awaitTermination()
    if silver:
        start_silver(spark, config, checkpoints, registry, gold).awaitTermination()


class ProgressMetrics(StreamingQueryListener):
    """Every batch of every query as a line of the metrics: rows, rate and time; and how a query ended."""

    def __init__(self, metrics: Metrics):
        self.metrics = metrics

    def onQueryStarted(self, event) -> None:
        self.metrics.emit("stream_started", query=str(event.id), run=str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.metrics.emit("stream_batch", query=str(p.id), batch=p.batchId, rows=p.numInputRows, rows_per_second=p.processedRowsPerSecond, elapsed_ms=p.batchDuration, status="success")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.metrics.emit("stream_ended", query=str(event.id), status="failed" if event.exception else "success", error=event.exception)


def connector_config(name: str, host: str, port: int, user: str, database: str, config: Config) -> dict:
    """The change connector's settings as a payload; the password is a reference to its own secret store."""
    # Names and settings of the connector's interface.
    return {
        "name": name,
        "config": {
            "connector.class": "io.debezium.connector.postgresql.PostgresConnector", "plugin.name": "pgoutput", "database.hostname": host, "database.port": str(port), "database.user": user,
            "database.password": "${file:/secrets/database.properties:password}", "database.dbname": database, "topic.prefix": config.topic_prefix,
            "table.include.list": ",".join(f"{config.source_schema}.{t}" for t in config.tables), "decimal.handling.mode": "string", "time.precision.mode": "connect", "tombstones.on.delete": "false",
        },
    }


def connector_healthy(status: dict) -> bool:
    """Whether the connector and all of its tasks, one at least, run."""
    tasks = status.get("tasks") or []
    return status.get("connector", {}).get("state") == "RUNNING" and bool(tasks) and all(t.get("state") == "RUNNING" for t in tasks)

