"""Typed configuration: YAML over a base file, environment variables, contract rules."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

from quarryline.operators.silver import TABLES

_VARIABLE = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::([^}]*))?\}")


class ConfigError(ValueError):
    """A configuration breaks a rule."""


@dataclass
class Config:
    base_path: str
    table_format: str = "parquet"
    write_mode: str = "overwrite"
    load_type: str = "full"
    lookback_minutes: int = 60
    tables: list[str] = field(default_factory=lambda: list(TABLES))
    incremental_columns: dict[str, str] = field(default_factory=dict)
    primary_keys: dict[str, list[str]] = field(default_factory=lambda: {t: [c] for t, c in _first_columns().items()})
    topic_prefix: str = "shop"
    source_schema: str = "public"
    topics: list[str] = field(default_factory=list)
    hard_deletes: bool = False
    trigger_seconds: int = 30
    spark: dict[str, str] = field(default_factory=dict)
    #: Options of a live source: a ``jdbc`` reader's (url, user, password, driver, ...).
    source_options: dict[str, str] = field(default_factory=dict)
    #: Options of the store under ``base_path``, set as Hadoop settings (``fs.*``).
    storage_options: dict[str, str] = field(default_factory=dict)

    def path(self, layer: str, table: str) -> str:
        return f"{self.base_path.rstrip('/')}/{layer}/{table}"

    def topic(self, table: str) -> str:
        return f"{self.topic_prefix}.{self.source_schema}.{table}"


def _first_columns() -> dict[str, str]:
    from quarryline.operators.silver import CONTRACT

    return {t: c[0] for t, c in CONTRACT.items()}


def merged(base: dict, over: dict) -> dict:
    """``over`` on top of ``base``, mappings merged at every depth."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def expanded(value, environment: dict[str, str] | None = None):
    """``${NAME}`` and ``${NAME:default}`` replaced, at every depth; an unset name without default is an error."""
    env = os.environ if environment is None else environment
    if isinstance(value, dict):
        return {k: expanded(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [expanded(v, env) for v in value]
    if not isinstance(value, str):
        return value

    def put(m: re.Match) -> str:
        if m[1] in env:
            return env[m[1]]
        if m[2] is None:
            raise ConfigError(f"environment variable {m[1]} is not set")
        return m[2]

    return _VARIABLE.sub(put, value)


def checked(c: Config) -> Config:
    """The contract rules."""
    if not c.base_path:
        raise ConfigError("base_path is empty")
    if c.table_format != "parquet":
        raise ConfigError(f"table format {c.table_format!r}: tables are versions over Parquet files; no other format is written")
    if c.write_mode not in ("overwrite", "append"):
        raise ConfigError(f"unknown write mode {c.write_mode!r}")
    if c.load_type not in ("full", "incremental"):
        raise ConfigError(f"unknown load type {c.load_type!r}")
    if not c.tables or len(set(c.tables)) != len(c.tables):
        raise ConfigError("tables must be named once each")
    if missing := [t for t in c.tables if not c.primary_keys.get(t)]:
        raise ConfigError(f"tables without primary key: {missing}")
    if unknown := set(c.incremental_columns) - set(c.tables):
        raise ConfigError(f"incremental columns of unknown tables: {sorted(unknown)}")
    if c.topics and set(c.topics) != {c.topic(t) for t in c.tables}:
        raise ConfigError("topics must be those of the source tables")
    if c.lookback_minutes < 0 or c.trigger_seconds <= 0:
        raise ConfigError("lookback and trigger must not be negative")
    return c


def dotenv(path: str) -> dict[str, str]:
    """Names and values of a ``.env`` file: comments and blank lines aside, ``export`` and quotes dropped."""
    out = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                name, sign, value = line.strip().removeprefix("export ").partition("=")
                if sign and not name.startswith("#"):
                    value = value.strip()
                    out[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'" else value
    return out


def load_config(path: str, environment: dict[str, str] | None = None) -> Config:
    """A YAML file over ``base.yaml`` beside it, if there is one; variables from the environment, then from ``.env`` beside it."""
    import yaml

    if environment is None:
        environment = dotenv(os.path.join(os.path.dirname(path), ".env")) | dict(os.environ)

    values: dict = {}
    for p in (os.path.join(os.path.dirname(path), "base.yaml"), path):
        if os.path.exists(p):
            with open(p, encoding="utf-8") as f:
                values = merged(values, yaml.safe_load(f) or {})
    known = Config.__dataclass_fields__
    if unknown := set(values) - set(known):
        raise ConfigError(f"unknown settings {sorted(unknown)}")
    return checked(Config(**expanded(values, environment)))
