"""Change events: envelope, validity, latest per key, alignment, application."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarryline.functions.labels import all_of
from quarryline.operators.merge import delete_keys, mark_deleted, merge_changes, upsert
from quarryline.operators.silver import silver

# The operation codes of the change envelope.
OPERATIONS = {"c": "INSERT", "r": "INSERT", "u": "UPDATE", "d": "DELETE"}
UNKNOWN_OPERATION = "UNKNOWN"

EVENT_COLUMNS = {
    "_kafka_topic": "string", "_kafka_partition": "long", "_kafka_offset": "long", "_kafka_timestamp": "timestamp",
    "_debezium_key": "string", "_debezium_value": "string", "op": "string", "source_ts_ms": "long", "source_db": "string",
    "source_schema": "string", "source_table": "string", "before_json": "string", "after_json": "string", "_bronze_ingested_at": "timestamp",
}
PARSED_COLUMNS = {
    "operation": "string", "table_name": "string", "event_ts": "timestamp", "record_json": "string", "primary_key_json": "string",
    "_cdc_event_id": "string", "is_valid_event": "boolean", "error_reason": "string",
}


def log_schema() -> T.StructType:
    kinds = {"string": T.StringType(), "long": T.LongType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType()}
    return T.StructType([T.StructField(c, kinds[k]) for c, k in (EVENT_COLUMNS | PARSED_COLUMNS).items()])


#: The message's envelope; images stay JSON texts, as their columns differ by table.
ENVELOPE = "op string, ts_ms string, source struct<db string, schema string, table string>, before string, after string"


def normalized(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Message rows (topic, partition, offset, timestamp, key, value) as event columns; each message is parsed once."""
    value = F.col("value").cast("string")
    return raw.withColumn("_m", F.from_json(value, ENVELOPE)).select(
        F.col("topic").cast("string").alias("_kafka_topic"), F.col("partition").cast("long").alias("_kafka_partition"),
        F.col("offset").cast("long").alias("_kafka_offset"), F.col("timestamp").cast("timestamp").alias("_kafka_timestamp"),
        F.col("key").cast("string").alias("_debezium_key"), value.alias("_debezium_value"),
        F.col("_m.op").alias("op"), F.col("_m.ts_ms").try_cast("long").alias("source_ts_ms"), F.col("_m.source.db").alias("source_db"),
        F.col("_m.source.schema").alias("source_schema"), F.col("_m.source.table").alias("source_table"),
        F.col("_m.before").alias("before_json"), F.col("_m.after").alias("after_json"),
        (F.current_timestamp() if now is None else now).alias("_bronze_ingested_at"),
    )


def operation_of(op: Column) -> Column:
    out = F.lit(UNKNOWN_OPERATION)
    for code, name in OPERATIONS.items():
        out = F.when(op == code, F.lit(name)).otherwise(out)
    return out


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("long"))


def parsed(events: DataFrame) -> DataFrame:
    """Adds operation, table, time, record (the image that holds the row) and event id."""
    image = F.when(F.col("op") == "d", F.col("before_json")).otherwise(F.col("after_json"))
    place = F.concat_ws("||", "_kafka_topic", F.col("_kafka_partition").cast("string"), F.col("_kafka_offset").cast("string"))
    return events.withColumns({
        "operation": operation_of(F.col("op")), "table_name": F.col("source_table"), "event_ts": from_millis(F.col("source_ts_ms")),
        "record_json": image, "primary_key_json": F.col("_debezium_key"), "_cdc_event_id": F.sha2(place, 256),
    })


def validated(events: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Adds ``is_valid_event`` and the first reason that makes an event invalid."""
    reasons = [
        (F.col("operation") == UNKNOWN_OPERATION, F.lit("unsupported_operation")),
        (F.col("record_json").isNull(), F.lit("missing_payload")),
        (F.col("table_name").isNull(), F.lit("missing_table")),
        (F.col("_kafka_offset").isNull(), F.lit("missing_offset")),
        (~F.col("table_name").isin(*tables), F.concat(F.lit("unmonitored_table:"), F.col("table_name"))),
    ]
    why = F.lit(None).cast("string")
    for test, reason in reversed(reasons):
        why = F.when(F.coalesce(test, F.lit(True)), reason).otherwise(why)
    return events.withColumn("error_reason", why).withColumn("is_valid_event", F.col("error_reason").isNull())


def routed(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid events, dead letters)."""
    return events.where("is_valid_event"), events.where("NOT is_valid_event")


def key_from_json(key: str) -> Column:
    """A key's text: from the record, the message key, or the message key's payload."""
    return F.coalesce(F.get_json_object("record_json", f"$.{key}"), F.get_json_object("primary_key_json", f"$.{key}"), F.get_json_object("primary_key_json", f"$.payload.{key}"))


def latest_per_key(events: DataFrame, keys: Sequence[str], at: str = "event_ts") -> DataFrame:
    """The last event of each key: by time, partition and offset; null keys go."""
    order = [F.col(c).desc_nulls_last() for c in (at, "_kafka_partition", "_kafka_offset") if c in events.columns]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return events.where(all_of([F.col(k).isNotNull() for k in keys])).withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def record_rows(events: DataFrame, table: str, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """Valid events of a table as rows of ``schema`` with change metadata, one row a key."""
    own = events.where((F.col("table_name") == table) & F.col("is_valid_event"))
    record = F.from_json("record_json", schema)
    fields = [F.col("_record")[f.name].alias(f.name) for f in schema if f.name not in keys]
    rows = own.withColumn("_record", record).select(
        *[key_from_json(k).alias(k) for k in keys], *fields, "operation", F.col("event_ts").alias("_cdc_event_ts"), "_cdc_event_id",
        "_kafka_topic", "_kafka_partition", "_kafka_offset", F.current_timestamp().alias("_bronze_ingested_at"),
    )
    return mark_deleted(latest_per_key(rows, keys, "_cdc_event_ts"))


_EPOCH_KINDS = (T.LongType, T.IntegerType)


def aligned(rows: DataFrame, target: T.StructType) -> DataFrame:
    """``rows`` in the target's columns and types, evolved columns last.

    Integers become timestamps as milliseconds and dates as days since the
    epoch; columns that the rows lack are null.
    """
    out = []
    for f in target:
        if f.name not in rows.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c, have = F.col(f.name), rows.schema[f.name].dataType
        if isinstance(have, _EPOCH_KINDS) and isinstance(f.dataType, T.TimestampType):
            c = from_millis(c)
        elif isinstance(have, _EPOCH_KINDS) and isinstance(f.dataType, T.DateType):
            c = F.date_add(F.lit("1970-01-01").cast("date"), c.cast("int"))
        elif have != f.dataType:
            c = c.try_cast(f.dataType)
        out.append(c.alias(f.name))
    known = {f.name for f in target}
    return rows.select(*out, *[c for c in rows.columns if c not in known])


@dataclass
class TableChange:
    bronze: DataFrame
    silver: DataFrame


def apply_changes(changes: DataFrame, bronze: DataFrame, silver_target: DataFrame, table: str, keys: Sequence[str], hard: bool = False, guard: bool = False) -> TableChange:
    """The next Bronze and Silver states after one batch's latest rows.

    Bronze keeps a tombstone with ``is_deleted`` unless ``hard``; Silver loses
    deleted keys and gets all others. ``guard`` refuses rows older than the
    Bronze row they would replace.
    """
    rows = aligned(changes, bronze.schema)
    newer = F.col("s._cdc_event_ts") >= F.col("t._cdc_event_ts") if guard and "_cdc_event_ts" in bronze.columns else None
    if newer is not None:
        stale = rows.alias("s").join(bronze.alias("t"), list(keys)).where(~F.coalesce(newer, F.lit(True))).select(*[F.col(f"s.{k}") for k in keys])
        rows = rows.join(stale.distinct(), list(keys), "left_anti")
    after = merge_changes(bronze, rows, keys) if hard else upsert(bronze, rows, keys)
    deleted = rows.where(F.col("operation") == "DELETE")
    live = aligned(silver(rows.where(F.col("operation") != "DELETE"), table, keys), silver_target.schema)
    return TableChange(after, upsert(delete_keys(silver_target, deleted, keys), live, keys))
