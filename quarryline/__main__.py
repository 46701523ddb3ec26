"""``python -m quarryline``: batch, stream, validate, inspect, init, connect, preflight."""

from __future__ import annotations

import argparse
import logging
import os
import shutil
import signal
import sys
import threading

from quarryline.logs import configure
from quarryline.plans import batch
from quarryline.plans.config import Config, load_config
from quarryline.plans.steps import batch_steps, run_steps
from quarryline.session import build_session
from quarryline.sources import live
from quarryline.sources.readers import Watermarks, broker_stream, layer_reader, message_stream, read_source
from quarryline.sources.storage import Store

log = logging.getLogger("quarryline")
POLL_SECONDS = 5


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quarryline", description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)
    for name in ("batch", "stream", "validate", "inspect", "init", "connect"):
        c = commands.add_parser(name)
        c.add_argument("--config", required=True)
        c.add_argument("--master")
    f = commands.add_parser("preflight")
    f.add_argument("--config")
    b, s, i = (commands.choices[n] for n in ("batch", "stream", "inspect"))
    b.add_argument("--source", help="folder with one Parquet table per source table; without it the database of source_options is read")
    b.add_argument("--retries", type=int, default=0, help="attempts of a step after its first")
    b.add_argument("--layers", nargs="+", default=["bronze", "silver", "gold"], choices=["bronze", "silver", "gold"])
    b.add_argument("--validate", action="store_true")
    b.add_argument("--metrics")
    s.add_argument("--messages", help="folder of message files; without it the broker is read")
    s.add_argument("--servers", default="")
    s.add_argument("--checkpoints", required=True)
    s.add_argument("--schemas", required=True)
    s.add_argument("--once", action="store_true")
    s.add_argument("--bronze-only", action="store_true")
    s.add_argument("--metrics")
    commands.choices["init"].add_argument("script", help="SQL file, run in one transaction on the database of source_options")
    k = commands.choices["connect"]
    k.add_argument("--service", required=True, help="address of the connector service")
    k.add_argument("--name", default="shop-connector")
    k.add_argument("--host", required=True)
    k.add_argument("--port", type=int, default=5432)
    k.add_argument("--user", required=True)
    k.add_argument("--database", required=True)
    k.add_argument("--wait", type=float, default=60.0)
    i.add_argument("layer")
    i.add_argument("table")
    i.add_argument("--sql")
    i.add_argument("--limit", type=int, default=20)
    i.add_argument("--schema", action="store_true")
    return p


def preflight(config: Config | None = None) -> dict[str, bool]:
    """What a run needs and whether it is there; with a configuration also what its settings name."""
    found = {"python": sys.version_info >= (3, 11), "java": shutil.which("java") is not None or os.path.exists(os.path.join(os.environ.get("JAVA_HOME", ""), "bin", "java")), "docker": shutil.which("docker") is not None}
    if config is not None:
        if config.source_options:
            found["source credentials"] = all(config.source_options.get(k) for k in ("url", "user", "password"))
        if "://" in config.base_path and not config.base_path.startswith("file:"):
            found["storage options"] = any(k.startswith("fs.") for k in config.storage_options)
    return found


#: What a run can do without.
OPTIONAL = ("docker",)


def session(config: Config, master: str | None):
    """The session, with the store's options as Hadoop settings."""
    return build_session("quarryline", master, config.spark | {f"spark.hadoop.{k}": v for k, v in config.storage_options.items()})


def run_until_stopped(queries: list, stop: threading.Event) -> None:
    """Wait for a stop, or for a query to end or fail; then stop all of them."""
    try:
        while not stop.wait(POLL_SECONDS):
            for q in queries:
                if not q.isActive:
                    if q.exception():
                        raise q.exception()
                    return
    finally:
        for q in queries:
            q.stop()


def stream(spark, config: Config, args: argparse.Namespace) -> None:
    from quarryline.operators.schema_registry import SchemaRegistry
    from quarryline.streaming.cdc_stream import ProgressMetrics, run_stream, start_bronze, start_silver

    topics = config.topics or [config.topic(t) for t in config.tables]
    messages = message_stream(spark, args.messages) if args.messages else broker_stream(spark, args.servers, topics)
    registry = SchemaRegistry(args.schemas, spark)
    if args.metrics:
        spark.streams.addListener(ProgressMetrics(batch.Metrics(args.metrics, spark)))
    if args.once:
        run_stream(spark, config, messages, args.checkpoints, registry, not args.bronze_only, not args.bronze_only)
        return
    stop = threading.Event()
    for s in (signal.SIGINT, signal.SIGTERM):
        signal.signal(s, lambda *_: stop.set())
    queries = start_bronze(spark, config, messages, args.checkpoints, once=False)
    if not args.bronze_only:
        queries.append(start_silver(spark, config, args.checkpoints, registry, once=False))
    run_until_stopped(queries, stop)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    configure()
    if args.command == "preflight":
        found = preflight(load_config(args.config) if args.config else None)
        for name, there in found.items():
            log.info("%s: %s", name, "found" if there else "missing")
        return int(not all(there for name, there in found.items() if name not in OPTIONAL))
    config = load_config(args.config)
    if args.command == "connect":
        from quarryline.streaming.cdc_stream import connector_config
        from quarryline.streaming.connector import ConnectorService

        service = ConnectorService(args.service)
        service.register(connector_config(args.name, args.host, args.port, args.user, args.database, config))
        log.info("%s", service.wait(args.name, args.wait))
        return 0
    spark = session(config, args.master)
    if args.command == "batch":
        marks = Watermarks(f"{config.base_path}/_control/watermarks.json", spark) if config.load_type == "incremental" else None
        sources = (lambda t: read_source(spark, f"{args.source}/{t}.parquet")) if args.source else live.table_reader(spark, config, marks.get if marks else None)
        metrics = batch.Metrics(args.metrics, spark)
        if args.retries:
            steps = [s for s in batch_steps(spark, config, sources, marks, args.retries) if s.name.split()[0] in (*args.layers, *(["validate"] if args.validate else []))]
            run_steps(steps, metrics)
        else:
            batch.run_batch(spark, config, sources, tuple(args.layers), args.validate, marks, metrics)
    elif args.command == "init":
        folder, _, name = args.script.rpartition("/")
        log.info("%d statements", live.run_script(spark, config.source_options, Store(spark, folder or ".").read(name)))
    elif args.command == "stream":
        stream(spark, config, args)
    elif args.command == "validate":
        checks = batch.validate_lake(spark, config)
        for c in checks:
            log.log(logging.INFO if c.passed else logging.ERROR, "%s expected %s, found %s", c.name, c.expected, c.actual)
        return int(not all(c.passed for c in checks))
    else:
        rows = layer_reader(spark, config.base_path, args.layer)(args.table)
        if args.schema:
            rows.printSchema()
        batch.inspect(rows, args.sql, args.limit).show(args.limit, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
