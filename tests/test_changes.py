import json
from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from quarryline.operators import cdc, impact, ledger
from quarryline.operators import schema_registry as reg
from quarryline.operators.silver import one_per_key, silver

MESSAGE = "topic string, partition long, offset long, timestamp timestamp, key string, value string"


def message(offset, op, before=None, after=None, table="app_users", ts=1000, partition=0):
    value = json.dumps({"op": op, "ts_ms": ts, "source": {"db": "d", "schema": "public", "table": table}, "before": before, "after": after})
    return ("t", partition, offset, datetime(2026, 1, 1), json.dumps({"user_id": (after or before or {}).get("user_id")}), value)


def events(spark, *messages):
    return cdc.validated(cdc.parsed(cdc.normalized(spark.createDataFrame(list(messages), MESSAGE))), ["app_users"])


def test_operations_and_reasons(spark):
    rows = events(spark, message(0, "c", after={"user_id": 1}), message(1, "r", after={"user_id": 1}), message(2, "u", {"user_id": 1}, {"user_id": 1}), message(3, "d", before={"user_id": 1}), message(4, "t"), message(5, "c"), message(6, "c", after={"user_id": 1}, table=None), message(7, "c", after={"user_id": 1}, table="x"), ("t", 0, None, None, None, message(8, "c", after={"user_id": 1})[5]))
    found = {r._kafka_offset: (r.operation, r.error_reason) for r in rows.collect()}
    assert found == {0: ("INSERT", None), 1: ("INSERT", None), 2: ("UPDATE", None), 3: ("DELETE", None), 4: ("UNKNOWN", "unsupported_operation"), 5: ("INSERT", "missing_payload"), 6: ("INSERT", "missing_table"), 7: ("INSERT", "unmonitored_table:x"), None: ("INSERT", "missing_offset")}
    good, bad = cdc.routed(rows)
    assert good.count() + bad.count() == rows.count()


def test_latest_wins_and_keys_fall_back(spark):
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("name", T.StringType())])
    rows = events(spark, message(1, "u", {"user_id": 1}, {"user_id": 1, "name": "old"}, ts=1000), message(0, "u", {"user_id": 1}, {"user_id": 1, "name": "new"}, ts=2000), message(2, "d", before={"user_id": 2}))
    found = cdc.record_rows(rows, "app_users", ["user_id"], schema).collect()
    assert {r.user_id: (r.name, r.is_deleted) for r in found} == {"1": ("new", False), "2": (None, True)}
    keyed = spark.createDataFrame([("{}", '{"payload":{"user_id":9}}')], "record_json string, primary_key_json string")
    assert keyed.select(cdc.key_from_json("user_id")).first()[0] == "9"


def test_alignment(spark):
    source = spark.createDataFrame([("7", 1767225600000, 20454, 1)], "id string, at long, day long, extra int")
    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampType()), T.StructField("day", T.DateType()), T.StructField("gone", T.StringType())])
    row = cdc.aligned(source, target)
    assert row.columns == ["id", "at", "day", "gone", "extra"]
    assert tuple(row.first()) == (7, datetime(2026, 1, 1), date(2026, 1, 1), None, 1)


def test_soft_and_hard_deletes(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "user_id long, name string")
    changes = spark.createDataFrame([(1, "z", "DELETE", True), (3, "c", "INSERT", False)], "user_id long, name string, operation string, is_deleted boolean")
    soft = cdc.apply_changes(changes, base, base, "x", ["user_id"])
    assert {(r.user_id, r.is_deleted) for r in soft.bronze.collect()} == {(1, True), (2, None), (3, False)}
    assert {r.user_id for r in soft.silver.collect()} == {2, 3}
    hard = cdc.apply_changes(changes, base, base, "x", ["user_id"], hard=True)
    assert {r.user_id for r in hard.bronze.collect()} == {2, 3}


def test_type2_changes(spark):
    def event(op, before, after):
        return ("app_users", op, json.dumps(before) if before else None, json.dumps(after) if after else None, True)

    rows = spark.createDataFrame([event("UPDATE", {"user_id": 1, "email": "a"}, {"user_id": 1, "email": "b"}), event("UPDATE", {"user_id": 2, "email": "a", "last_login": 1}, {"user_id": 2, "email": "a", "last_login": 2}), event("DELETE", {"user_id": 3}, None), event("UPDATE", {"user_id": 4}, {"user_id": 4})], "table_name string, operation string, before_json string, after_json string, is_valid_event boolean")
    found = impact.changed_values(impact.type2_events(rows), "app_users", "user_id")
    assert sorted(r.user_id for r in found.collect()) == [1, 3]


def test_moved_line_touches_both_orders(spark):
    row = [("order_items", '{"order_id":1}', '{"order_id":2}', True)]
    changes = spark.createDataFrame(row, "table_name string, before_json string, after_json string, is_valid_event boolean")
    tables = {
        "orders": "order_id long, customer_id long, shipping_address_id long, billing_address_id long", "order_items": "order_id long, product_id long, product_variant_id long, shop_id long",
        "products": "product_id long, category_id long", "order_vouchers": "order_id long, voucher_id long",
    }
    found = impact.impacted_orders(changes, lambda t: spark.createDataFrame([], tables[t]))
    assert sorted(r.order_id for r in found.collect()) == [1, 2]


def test_impacted_rows_of_every_dimension(spark):
    """Feeds of one and of two columns, by changed keys and by facts; rows reached twice come once."""
    schema = "table_name string, before_json string, after_json string, is_valid_event boolean"
    changes = spark.createDataFrame([("categories", '{"category_id":1}', None, True), ("products", '{"product_id":5}', '{"product_id":6}', True), ("product_variants", None, '{"product_variant_id":51}', True), ("shops", None, '{"shop_id":7}', True)], schema)
    facts = spark.createDataFrame([(20260101, 9), (None, 9)], "order_date_key int, payment_key long")
    dimensions = {
        "dim_category": ("source_category_id long, source_parent_category_id long", [(1, None), (2, 1), (3, 2), (4, None)], {1, 2}),
        "dim_product": ("source_product_variant_id long, source_product_id long", [(50, 5), (51, 5), (60, 6), (70, 8)], {50, 51, 60}),
        "dim_shop": ("source_shop_id long, name string", [(7, "a"), (8, "b")], {7}),
        "dim_location": ("source_address_id long, city string", [(1, "a")], set()),
        "dim_date": ("date_key int, y int", [(20260101, 1), (20260102, 1)], {20260101}),
        "dim_payment": ("payment_key long, m string", [(9, "a"), (0, "b")], {9}),
    }
    for name, (columns, rows, expected) in dimensions.items():
        found = impact.impacted_dimension(name, spark.createDataFrame(rows, columns), changes, facts)
        assert found.columns == [c.split()[0] for c in columns.split(", ")]
        keys = [r[0] for r in found.collect()]
        assert sorted(keys) == sorted(expected), name


def struct(**kinds):
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


@pytest.mark.parametrize(("old", "new", "fits"), [(T.IntegerType(), T.LongType(), True), (T.LongType(), T.IntegerType(), False), (T.NullType(), T.StringType(), True), (T.DecimalType(10, 2), T.DecimalType(12, 2), True), (T.DecimalType(10, 2), T.DecimalType(10, 4), False), (T.StringType(), T.LongType(), False)])
def test_type_compatibility(old, new, fits):
    assert reg.compatible(old, new) is fits


def test_breaking_changes(tmp_path):
    registry = reg.SchemaRegistry(str(tmp_path))
    registry.register("t", struct(a=T.LongType(), b=T.StringType()), ["a"])
    registry.register("t", struct(a=T.LongType(), b=T.StringType(), c=T.StringType()), ["a"])
    assert len(registry.versions("t")) == 2
    for schema, keys in ((struct(a=T.LongType()), ["a"]), (struct(a=T.StringType(), b=T.StringType(), c=T.StringType()), ["a"]), (struct(a=T.LongType(), b=T.StringType(), c=T.StringType()), ["b"])):
        with pytest.raises(reg.SchemaCompatibilityError):
            registry.register("t", schema, keys)
    strict = T.StructType([*struct(a=T.LongType(), b=T.StringType(), c=T.StringType()), T.StructField("d", T.LongType(), False)])
    with pytest.raises(reg.SchemaCompatibilityError):
        registry.register("t", strict, ["a"])


def test_inference_and_history(spark, tmp_path):
    registry = reg.SchemaRegistry(str(tmp_path))
    first = spark.createDataFrame([('{"id":1,"name":"x"}',), (None,)], "record_json string")
    assert registry.resolve("t", first) == struct(id=T.LongType(), name=T.StringType())
    registry.register("t", registry.resolve("t", first), ["id"])
    second = spark.createDataFrame([('{"id":null,"more":2.5}',)], "record_json string")
    assert registry.resolve("t", second) == struct(id=T.LongType(), more=T.DoubleType(), name=T.StringType())
    assert reg.infer(first.limit(0)) == T.StructType([])


def test_ledger_skips_committed_batches(spark, tmp_path):
    book = ledger.Ledger(spark, str(tmp_path))
    rows = events(spark, message(5, "c", after={"user_id": 1}), message(12, "c", after={"user_id": 2}))
    done = []
    assert book.process(rows, 0, lambda r: done.append(r.count())) == "COMMITTED"
    assert book.process(rows, 1, lambda r: done.append(r.count())) == "SKIPPED"
    assert done == [2]
    assert book.watermarks.read().first().max_offset == 12
    assert book.process(rows.limit(0), 2, lambda r: done.append(0)) == "EMPTY"


def test_ledger_keeps_failures(spark, tmp_path):
    book = ledger.Ledger(spark, str(tmp_path))
    rows = events(spark, message(1, "c", after={"user_id": 1}))

    def fail(_):
        raise RuntimeError("x" * 9000)

    with pytest.raises(RuntimeError):
        book.process(rows, 0, fail)
    row = book.commits.read().first()
    assert row.status == "FAILED" and len(row.error_message) == ledger.ERROR_CHARS
    began = row.started_at
    book.process(rows, 0, lambda r: None)
    row = book.commits.read().first()
    assert row.status == "COMMITTED" and row.started_at == began and row.committed_at is not None


def test_silver_contract(spark):
    rows = spark.createDataFrame([(1, " Shop ", "x", True, "b"), (2, " A ", "x", False, "b"), (2, "B", "x", None, "a")], "shop_id long, shop_name string, other string, is_deleted boolean, _meta string")
    found = silver(rows, "shops")
    assert found.columns == ["shop_id", "shop_name"]
    assert [tuple(r) for r in found.collect()] == [(2, "A")]


def test_survivor_is_fixed(spark):
    rows = spark.createDataFrame([(1, "b", None), (1, "a", 2), (1, "a", 1)], "k int, v string, n int")
    assert tuple(one_per_key(rows, ["k"]).first()) == (1, "a", 1)


def test_missing_line_amounts_are_recomputed(spark):
    from decimal import Decimal as D

    schema = "order_item_id long, order_id long, quantity long, unit_price decimal(12,2), item_subtotal decimal(12,2), discount_amount decimal(12,2), tax_amount decimal(12,2), item_total decimal(12,2)"
    rows = spark.createDataFrame([(1, 1, 3, D("2.50"), None, D("0.50"), D("1.00"), None)], schema)
    row = silver(rows, "order_items").first()
    assert (row.item_subtotal, row.item_total) == (D("7.50"), D("8.00"))
