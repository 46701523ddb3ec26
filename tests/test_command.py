import json
import logging
import threading
import time
from datetime import datetime
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from quarryline import __main__ as command
from quarryline.logs import JsonFormatter
from quarryline.plans import fact
from quarryline.plans.batch import Metrics
from quarryline.plans.config import Config, ConfigError, load_config
from quarryline.plans.steps import Step, StepFailed, run_steps
from quarryline.sources import demo, live
from quarryline.streaming.connector import ConnectorError, ConnectorService


def test_batch_validate_inspect(spark, sf_dir, tmp_path, capsys, monkeypatch):
    t = demo.sources(spark, sf_dir)
    t = fact.scoped(t, t["orders"].where("customer_id < 5").select("order_id"))
    for name, rows in t.items():
        rows.write.parquet(str(tmp_path / "source" / f"{name}.parquet"))
    (tmp_path / "c.yaml").write_text(f"base_path: {tmp_path}/lake\n")
    monkeypatch.setattr(command, "build_session", lambda *a: spark)
    config = ["--config", str(tmp_path / "c.yaml")]
    assert command.main(["batch", *config, "--source", str(tmp_path / "source"), "--validate", "--metrics", str(tmp_path / "metrics")]) == 0
    (file,) = (tmp_path / "metrics").glob("*.jsonl")
    assert {json.loads(x)["status"] for x in file.read_text().splitlines()} == {"success"}
    assert command.main(["validate", *config]) == 0
    assert command.main(["inspect", *config, "gold", "fact_sales", "--sql", "SELECT count(*) AS n FROM t", "--schema"]) == 0
    assert str(t["order_items"].count()) in capsys.readouterr().out


def test_preflight():
    assert set(command.preflight()) == {"python", "java", "docker"}
    found = command.preflight(Config("abfss://a@b/c", source_options={"url": "jdbc:x", "user": "u"}, storage_options={"fs.azure.account.key": "k"}))
    assert not found["source credentials"] and found["storage options"]


def test_scripts_are_cut_at_statements():
    script = "CREATE TABLE a (x int); -- one; two\nINSERT INTO a VALUES ('1;2'); /* ; */\nCREATE FUNCTION f() AS $body$ BEGIN; END; $body$ LANGUAGE x;\n ;SELECT 1"
    assert list(live.statements(script)) == ["CREATE TABLE a (x int)", "INSERT INTO a VALUES ('1;2')", "CREATE FUNCTION f() AS $body$ BEGIN; END; $body$ LANGUAGE x", "SELECT 1"]


@pytest.fixture
def database(spark):
    """An in-memory database, where Spark brings one along."""
    url = f"jdbc:derby:memory:t{time.time_ns()};create=true"
    options = {"url": url, "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    try:
        live.run_script(spark, options, "CREATE SCHEMA shop; CREATE TABLE shop.orders (order_id BIGINT, created_at TIMESTAMP); INSERT INTO shop.orders VALUES (1, '2026-01-01 10:00:00'), (2, '2026-01-02 10:00:00')")
    except Exception as missing:
        if "ClassNotFound" in str(missing) or "No suitable driver" in str(missing):
            pytest.skip("no database driver")
        raise
    return options


def test_live_database(spark, database):
    config = Config("x", source_schema="shop", source_options=database, load_type="incremental", incremental_columns={"orders": "created_at"})
    assert live.table_reader(spark, config)("orders").count() == 2
    newer = live.table_reader(spark, config, lambda t: "2026-01-02 10:30:00")("orders")
    assert [r[0] for r in newer.collect()] == [2]
    assert live.query_reader(spark, config)("SELECT count(*) AS n FROM shop.orders").first()[0] == 2
    with pytest.raises(Exception, match="NOTHING"):
        live.run_script(spark, database, "INSERT INTO shop.orders VALUES (3, '2026-01-03 10:00:00'); INSERT INTO shop.nothing VALUES (1)")
    assert live.table_reader(spark, config)("orders").count() == 2  # one transaction
    with pytest.raises(ConfigError):
        live.table_reader(spark, Config("x"))


def test_rounds_of_changes(spark):
    rows = spark.range(1, 2001).selectExpr("id AS k", "TIMESTAMP '2026-01-01' AS at", "id % 7 AS v")
    one, again, other = (sorted(map(tuple, live.changing(rows, "k", "at", r).collect())) for r in (1, 1, 2))
    assert one == again != other
    old, new = [r for r in one if r[0] <= 2000], [r for r in one if r[0] > 2000]
    assert 60 < len(old) < 140 and 20 < len(new) < 70 and len({r[0] for r in one}) == len(one)
    assert all(r[1] > datetime(2026, 1, 1) for r in one)


def test_connector_service():
    class Handler(BaseHTTPRequestHandler):
        asked, states = [], iter(["FAILED", "RUNNING"])

        def answer(self, body, code=200):
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def do_PUT(self):
            self.asked.append((self.path, json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            self.answer({"name": "c"}, 201)

        def do_GET(self):
            state = next(self.states, None)
            self.answer({"connector": {"state": "RUNNING"}, "tasks": [{"state": state}]} if state else {"error": "gone"}, 200 if state else 404)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    service = ConnectorService(f"http://127.0.0.1:{server.server_port}")
    assert service.register({"name": "c", "config": {"a": "b"}}) == {"name": "c"}
    assert Handler.asked == [("/connectors/c/config", {"a": "b"})]
    assert service.wait("c", 5, 0.01)["tasks"] == [{"state": "RUNNING"}]
    with pytest.raises(ConnectorError, match="404"):
        service.wait("c", 0.05, 0.01)
    server.shutdown()
    with pytest.raises(ConnectorError):
        ConnectorService("http://127.0.0.1:9", 0.5).status("c")


def test_steps_are_retried_and_stop_at_a_failure():
    tried, metrics = [], Metrics()

    def flaky():
        tried.append(1)
        if len(tried) < 2:
            raise ValueError("once")
        return "ok"

    steps = [Step("a", lambda: 1), Step("b", flaky, 2), Step("c", lambda: 1 / 0, 1), Step("d", lambda: tried.append(9))]
    with pytest.raises(StepFailed, match="c: division"):
        run_steps(steps, metrics, pause=0)
    assert tried == [1, 1]
    assert [(x["step"], x["status"]) for x in map(json.loads, metrics.lines)] == [("a", "success"), ("b", "failed"), ("b", "success"), ("c", "failed"), ("c", "failed")]


def test_environment_file(tmp_path):
    (tmp_path / ".env").write_text("# notes\nexport BASE='/tmp/from env'\nOTHER=x=y\n\n")
    (tmp_path / "c.yaml").write_text("base_path: ${BASE}\nsource_schema: ${OTHER}\n")
    c = load_config(str(tmp_path / "c.yaml"))
    assert (c.base_path, c.source_schema) == ("/tmp/from env", "x=y")


class Query:
    def __init__(self, active=True, failure=None):
        self.isActive, self.failure, self.stopped = active, failure, False

    def exception(self):
        return self.failure

    def stop(self):
        self.stopped = True


def test_stopping(monkeypatch):
    monkeypatch.setattr(command, "POLL_SECONDS", 0.01)
    stop, queries = threading.Event(), [Query(), Query()]
    stop.set()
    command.run_until_stopped(queries, stop)
    assert all(q.stopped for q in queries)
    queries = [Query(), Query(False, RuntimeError("x"))]
    with pytest.raises(RuntimeError):
        command.run_until_stopped(queries, threading.Event())
    assert queries[0].stopped


def test_json_logs():
    record = logging.LogRecord("a", logging.INFO, "p", 1, "hello %s", ("x",), None)
    assert json.loads(JsonFormatter().format(record))["message"] == "hello x"
