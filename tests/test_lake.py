import json

import pytest
from pyspark.sql import functions as F

from quarryline.operators.schema_registry import SchemaRegistry
from quarryline.plans import batch, config, fact
from quarryline.plans import dimensions as d
from quarryline.plans.incremental import gold_table
from quarryline.plans.reconcile import as_frame
from quarryline.sources import demo
from quarryline.sources.readers import Watermarks, layer_reader, message_stream
from quarryline.streaming import cdc_stream

AUDIT = ("created_at", "updated_at")


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    cfg = config.checked(config.Config(base))
    # customers 0..39 with their orders: small, and every kind of row
    t = demo.sources(spark, sf_dir)
    some = t["orders"].where("customer_id < 40").select("order_id")
    t = fact.scoped(t, some)
    checks = batch.run_batch(spark, cfg, t.__getitem__)
    return cfg, checks, t


def rows(df):
    return sorted(map(str, df.drop(*AUDIT).collect()))


def test_all_checks_pass(spark, lake):
    _, checks, _ = lake
    assert len(checks) == 40 and all(c.passed for c in checks)
    assert as_frame(spark, checks).where("NOT passed").count() == 0


def test_rerun_changes_nothing(spark, lake):
    cfg, _, _ = lake
    before = rows(gold_table(spark, cfg.base_path, "fact_sales").read())
    batch.load_gold(spark, cfg)
    assert rows(gold_table(spark, cfg.base_path, "fact_sales").read()) == before


def envelope(op, table, before, after, ts):
    def text(x):
        return x if isinstance(x, (int, bool, type(None))) else str(x)

    image = [None if r is None else {k: text(v) for k, v in r.items()} for r in (before, after)]
    return json.dumps({"op": op, "ts_ms": ts, "source": {"db": "shop", "schema": "public", "table": table}, "before": image[0], "after": image[1]})


def test_stream_equals_full_rebuild(spark, lake, tmp_path):
    cfg, _, _ = lake
    read = layer_reader(spark, cfg.base_path, "silver")
    user = read("app_users").where("user_id = 5").first().asDict()
    item = read("order_items").orderBy("order_item_id").first().asDict()
    address = read("user_addresses").where("address_id = 7").first().asDict()
    millis = {k: None if v is None else int(v.timestamp() * 1000) for k, v in user.items() if k in ("created_at", "updated_at", "last_login")}
    user |= millis | {"updated_at": 1_700_000_000_000}
    item["created_at"] = int(item["created_at"].timestamp() * 1000)
    lines = [
        ("app_users", envelope("u", "app_users", user, user | {"email": "new@example.com"}, 1_700_000_000_000), {"user_id": 5}),
        ("order_items", envelope("d", "order_items", item, None, 1_700_000_000_001), {"order_item_id": item["order_item_id"]}),
        ("user_addresses", envelope("u", "user_addresses", address, address | {"city": "Elsewhere"}, 1_700_000_000_002), {"address_id": 7}),
        ("app_users", envelope("t", "app_users", None, None, 1_700_000_000_003), {}),
    ]
    data = [(cfg.topic(t), 0, i, None, json.dumps(k), v) for i, (t, v, k) in enumerate(lines)]
    folder = str(tmp_path / "messages")
    spark.createDataFrame(data, "topic string, partition long, offset long, timestamp timestamp, key string, value string").write.parquet(folder)
    registry = SchemaRegistry(str(tmp_path / "schemas"))
    listener = cdc_stream.ProgressMetrics(batch.Metrics(str(tmp_path / "metrics"), spark))
    spark.streams.addListener(listener)
    cdc_stream.run_stream(spark, cfg, message_stream(spark, folder), str(tmp_path / "checkpoints"), registry)

    spark.streams.removeListener(listener)
    told = [json.loads(line) for line in listener.metrics.lines]
    assert sum(x["rows"] for x in told if x["name"] == "stream_batch") >= 7 and {x["status"] for x in told if "status" in x} == {"success"}
    assert read("app_users").where("email = 'new@example.com'").count() == 1
    assert read("order_items").where(F.col("order_item_id") == item["order_item_id"]).count() == 0
    history = gold_table(spark, cfg.base_path, "dim_customer").read().where("source_customer_id = 5")
    assert history.count() == 2 and history.where("is_current").count() == 1
    assert spark.read.parquet(cfg.path("bronze", "cdc_dead_letters")).count() == 1
    location = gold_table(spark, cfg.base_path, "dim_location").read().where("source_address_id = 7").first()
    assert location.city == "Elsewhere"

    # what was kept current equals what a rebuild would give
    star = fact.build_star({t: read(t) for t in cfg.tables}, gold_table(spark, cfg.base_path, "dim_customer").read())
    assert rows(gold_table(spark, cfg.base_path, "fact_sales").read()) == rows(star["fact_sales"])
    assert rows(gold_table(spark, cfg.base_path, "dim_location").read()) == rows(star["dim_location"])
    operations = {v.operation for v in gold_table(spark, cfg.base_path, "fact_sales").history()[1:]}
    assert operations == {"MERGE"}

    # a lost checkpoint replays the log, and the ledger and merges make that harmless
    before = rows(gold_table(spark, cfg.base_path, "fact_sales").read())
    cdc_stream.start_silver(spark, cfg, str(tmp_path / "other"), registry).awaitTermination()
    assert rows(gold_table(spark, cfg.base_path, "fact_sales").read()) == before
    failed = [c.name for c in batch.validate_lake(spark, cfg) if not c.passed]
    assert failed == ["cdc_dead_letter_count"]


def test_changes_need_loaded_tables(spark, tmp_path):
    cfg = config.Config(str(tmp_path / "none"))
    data = [(cfg.topic("shops"), 0, 0, None, '{"shop_id":1}', envelope("c", "shops", None, {"shop_id": 1}, 1))]
    events = cdc_stream.event_columns(spark.createDataFrame(data, "topic string, partition long, offset long, timestamp timestamp, key string, value string"), cfg.tables)
    with pytest.raises(FileNotFoundError):
        cdc_stream.apply_batch(spark, cfg, events, SchemaRegistry(str(tmp_path)))
    with pytest.raises(ValueError):
        cdc_stream.run_stream(spark, cfg, None, "", None, silver=False)


def test_write_mode_appends(spark, tmp_path):
    cfg = config.Config(str(tmp_path / "b"), write_mode="append")
    for state in "ab":
        batch.load_bronze(spark, cfg, "orders", spark.createDataFrame([(1, state)], "order_id long, state string"))
    assert sorted(r.state for r in batch.bronze_table(spark, cfg, "orders").read().collect()) == ["a", "b"]


def test_one_scan_finds_all_orphans(spark):
    from quarryline.plans import reconcile as r

    keys = {"a_key": ("a", "k", False), "b_key": ("b", "k", True), "c_key": ("b", "k", False)}
    rows = spark.createDataFrame([(1, 0, 0), (2, 5, None), (2, 6, 7), (9, 5, 7)], "a_key int, b_key long, c_key long")
    tables = {"a": spark.createDataFrame([(1,), (9,)], "k long"), "b": spark.createDataFrame([(5,)], "k int")}
    found = {x.fact_column: x.n for x in r.all_orphans(rows, tables.__getitem__, keys).collect()}
    assert found == {"a_key": 1, "b_key": 1, "c_key": 2}
    times = spark.range(1).select(r.is_fresh(F.lit("2026-01-10 9:00:00").cast("timestamp"), F.lit("2026-01-09 10:00:00").cast("timestamp")), r.is_fresh(F.lit(None).cast("timestamp"), F.lit(None).cast("timestamp")), r.is_fresh(F.lit(None).cast("timestamp"), F.lit("2026-01-09").cast("timestamp")))
    assert tuple(times.first()) == (True, True, False)


def test_incremental_bronze(spark, tmp_path):
    cfg = config.Config(str(tmp_path / "b"), load_type="incremental", incremental_columns={"orders": "created_at"}, lookback_minutes=60)
    marks = Watermarks(str(tmp_path / "marks.json"))
    schema = "order_id long, created_at timestamp, state string"

    def load(*data):
        batch.load_bronze(spark, cfg, "orders", spark.createDataFrame(list(data), "order_id long, at string, state string").select("order_id", F.col("at").cast("timestamp").alias("created_at"), "state"), marks)
        return {r.order_id: r.state for r in batch.bronze_table(spark, cfg, "orders").read().collect()}

    assert schema and load((1, "2026-01-01 10:00:00", "a"), (2, None, "a")) == {1: "a", 2: "a"}
    assert marks.get("orders").startswith("2026-01-01 10:00:00")
    assert load((1, "2026-01-01 09:30:00", "b"), (3, "2026-01-01 09:00:00", "b"), (4, "2026-01-01 11:00:00", "b")) == {1: "b", 2: "a", 4: "b"}
    with pytest.raises(ValueError):
        batch.load_bronze(spark, config.Config("x", primary_keys={}), "orders", None)


def test_reduced_payments(spark, sf_dir):
    t = demo.sources(spark, sf_dir)
    some = t["orders"].where("order_id < 20").select("order_id")
    t = fact.scoped(t, some)
    t["payments"] = t["payments"].unionByName(t["payments"].withColumn("payment_id", F.col("payment_id") + 1).withColumn("payment_method", F.lit("cod")))
    customers = d.customer_versions(d.dim_customer(t["app_users"], t["orders"]))
    n = t["order_items"].count()
    assert fact.fact_sales(t, customers).count() > n
    assert fact.fact_sales(t, customers, reduce_payments=True).count() == n


def test_shares_are_close_to_the_amounts(spark, sf_dir):
    t = demo.sources(spark, sf_dir)
    off = fact.allocated(t["order_items"], t["orders"]).groupBy("order_id").agg(F.abs(F.sum("order_discount_amount_allocated") - F.max("order_discount")).alias("off"), F.count("*").alias("n"))
    assert off.where("off > 0.005 * n").count() == 0


@pytest.mark.parametrize("bad", [{"base_path": ""}, {"table_format": "csv"}, {"table_format": "delta"}, {"write_mode": "x"}, {"load_type": "x"}, {"tables": []}, {"tables": ["orders", "orders"]}, {"primary_keys": {}}, {"incremental_columns": {"x": "y"}}, {"topics": ["x"]}, {"trigger_seconds": 0}])
def test_bad_settings(bad):
    with pytest.raises(config.ConfigError):
        config.checked(config.Config(**({"base_path": "x"} | bad)))


def test_config_file(tmp_path):
    (tmp_path / "base.yaml").write_text("base_path: /tmp/lake\nspark: {a: '1', b: '2'}\n")
    (tmp_path / "local.yaml").write_text("lookback_minutes: 5\nspark: {b: '${WHAT:3}'}\n")
    c = config.load_config(str(tmp_path / "local.yaml"), {})
    assert (c.base_path, c.lookback_minutes, c.spark) == ("/tmp/lake", 5, {"a": "1", "b": "3"})
    with pytest.raises(config.ConfigError):
        config.expanded("${MISSING}", {})


def test_connector():
    status = {"connector": {"state": "RUNNING"}, "tasks": [{"state": "RUNNING"}]}
    assert cdc_stream.connector_healthy(status)
    assert not cdc_stream.connector_healthy(status | {"tasks": []})
    assert not cdc_stream.connector_healthy(status | {"tasks": [{"state": "FAILED"}]})
    payload = cdc_stream.connector_config("c", "h", 5432, "u", "d", config.Config("x"))
    assert "public.orders" in payload["config"]["table.include.list"]


def test_metrics(spark, tmp_path):
    m = batch.Metrics(str(tmp_path / "m"), spark)
    with m.timer("a"):
        pass
    with pytest.raises(RuntimeError), m.timer("b"):
        raise RuntimeError
    (file,) = (tmp_path / "m").glob("*.jsonl")
    assert [json.loads(x)["status"] for x in file.read_text().splitlines()] == ["success", "failed"]


def test_inspect(spark, sf_dir):
    found = batch.inspect(demo.table(spark, sf_dir, "region"), "SELECT count(*) AS n FROM t")
    assert found.first().n == 5
