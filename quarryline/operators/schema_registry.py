"""Schemas of change payloads: inference, compatibility, evolution, persistence."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.sources.storage import Store

#: Numeric types from narrow to wide.
WIDENING = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


class SchemaCompatibilityError(ValueError):
    """A schema breaks what is registered."""


@dataclass
class Comparison:
    added: list[str] = field(default_factory=list)
    breaking: list[str] = field(default_factory=list)
    widened: list[str] = field(default_factory=list)


def compatible(old: T.DataType, new: T.DataType) -> bool:
    """Whether values of ``old`` fit ``new``: equal, unknown on a side, or wider."""
    if old == new or isinstance(old, T.NullType) or isinstance(new, T.NullType):
        return True
    if type(old) in WIDENING and type(new) in WIDENING:
        return WIDENING.index(type(old)) <= WIDENING.index(type(new))
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return False


def compare(old: T.StructType, new: T.StructType, old_keys: list[str] | None = None, new_keys: list[str] | None = None) -> Comparison:
    """What changed; ``breaking`` lists why the new schema must be refused."""
    out = Comparison()
    fresh = {f.name: f for f in new}
    for f in old:
        if f.name not in fresh:
            out.breaking.append(f"removed column {f.name}")
        elif not compatible(f.dataType, fresh[f.name].dataType):
            out.breaking.append(f"incompatible type of {f.name}: {f.dataType.simpleString()} to {fresh[f.name].dataType.simpleString()}")
        elif f.dataType != fresh[f.name].dataType and not isinstance(fresh[f.name].dataType, T.NullType):
            out.widened.append(f.name)
    if old_keys is not None and new_keys is not None and list(old_keys) != list(new_keys):
        out.breaking.append(f"changed primary key {old_keys} to {new_keys}")
    known = {f.name for f in old}
    for f in new:
        if f.name not in known:
            out.added.append(f.name)
            if not f.nullable:
                out.breaking.append(f"added column {f.name} does not allow nulls")
    return out


def present_keys(records: DataFrame, column: str = "record_json") -> DataFrame:
    """(key, has_value) of the top-level keys of JSON objects."""
    entries = F.explode(F.map_entries(F.from_json(column, "map<string,string>"))).alias("e")
    return records.where(F.col(column).isNotNull()).select(entries).groupBy(F.col("e.key").alias("key")).agg(F.bool_or(F.col("e.value").isNotNull()).alias("has_value"))


def infer(records: DataFrame, column: str = "record_json") -> T.StructType:
    """The schema of JSON texts; columns without any value are of unknown type.

    Key by key the types that occur are merged by Spark's own aggregate over
    parsed values, in the JVM and with partial results in every task.
    """
    valued = {r.key: r.has_value for r in present_keys(records, column).collect()}  # one row a column
    if not valued:
        return T.StructType([])
    parsed = F.try_parse_json(column)
    text = records.where(F.col(column).isNotNull()).agg(F.schema_of_variant_agg(parsed)).first()[0]
    guessed = {f.name: plain_type(f.dataType) for f in variant_fields(text)}
    kinds = ((n, guessed.get(n, T.StringType()) if valued[n] else T.NullType()) for n in sorted(valued))
    return T.StructType([T.StructField(n, k, True) for n, k in kinds])


def variant_fields(text: str | None) -> list[T.StructField]:
    """The fields that Spark reports for JSON objects; of other values there are none."""
    if not text or not text.startswith("OBJECT<"):
        return []
    return list(T.DataType.fromDDL(re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT<", "STRUCT<", text))))


def plain_type(kind: T.DataType) -> T.DataType:
    """Exact decimals of JSON numbers as doubles, as JSON readers have them; mixed kinds as texts."""
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, T.VariantType):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(plain_type(kind.elementType), True)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, plain_type(f.dataType), True) for f in kind])
    return kind


def resolved(registered: T.StructType | None, found: T.StructType) -> T.StructType:
    """Found columns with registered types where unknown, and registered columns that are absent."""
    if registered is None:
        return found
    known = {f.name: f for f in registered}
    fields = []
    for f in found:
        unknown = isinstance(f.dataType, T.NullType) and f.name in known
        fields.append(T.StructField(f.name, known[f.name].dataType if unknown else f.dataType, True))
    have = {f.name for f in found}
    fields += [T.StructField(f.name, f.dataType, True) for f in registered if f.name not in have]
    return T.StructType(fields)


class SchemaRegistry:
    """One JSON file of versions per table, written whole, on the file system that the folder names."""

    def __init__(self, folder: str, spark: SparkSession | None = None):
        spark = spark or SparkSession.getActiveSession()
        if spark is None:
            raise RuntimeError("no Spark session to reach the folder's file system with")
        self.store = Store(spark, folder)

    def versions(self, table: str) -> list[dict]:
        return self.store.read_json(f"{table}.json", {"versions": []})["versions"]

    def current(self, table: str) -> tuple[T.StructType, list[str]] | None:
        found = self.versions(table)
        return (T.StructType.fromJson(found[-1]["schema"]), found[-1]["keys"]) if found else None

    def resolve(self, table: str, records: DataFrame, column: str = "record_json") -> T.StructType:
        """The schema to read the records with; nothing is written."""
        before = self.current(table)
        return resolved(before[0] if before else None, infer(records, column))

    def register(self, table: str, schema: T.StructType, keys: list[str]) -> Comparison:
        """Add a version if the schema changed; refuse it if that breaks."""
        found = self.versions(table)
        change = Comparison()
        if found:
            old = T.StructType.fromJson(found[-1]["schema"])
            change = compare(old, schema, found[-1]["keys"], keys)
            if change.breaking:
                raise SchemaCompatibilityError(f"{table}: " + "; ".join(change.breaking))
            if not change.added and not change.widened:
                return change
        found = [*found, {"version": len(found) + 1, "schema": json.loads(schema.json()), "keys": list(keys)}]
        self.store.replace_json(f"{table}.json", {"table": table, "versions": found})
        return change
