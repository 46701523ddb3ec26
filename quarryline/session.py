"""Session builder and layer paths."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings every session of the engine has: UTC, ANSI and adaptive plans.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(name: str = "quarryline", master: str | None = None, settings: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    return builder.config(map=DEFAULTS | (settings or {})).getOrCreate()
