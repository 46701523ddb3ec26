"""The twelve commerce source tables, and change messages, derived from the benchmark tables.

Amounts are cast to decimals before any arithmetic, timestamps explicitly, and
line numbers are counted per order, so nothing needs a global order. The same
tables as SQL are in :data:`SOURCES_SQL`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MONEY = "decimal(12,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _at(days: Column) -> Column:
    return F.timestamp_add("DAY", days.cast("int"), F.lit("1992-01-01").cast("timestamp"))


def app_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("user_id"), F.concat(F.lit("U"), k.cast("string")).alias("public_user_id"), F.col("c_name").alias("username"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"), F.lit("Customer").alias("first_name"),
        F.when(k % 7 != 0, F.concat(F.lit("No"), k.cast("string"))).alias("last_name"), F.when(k % 10 != 0, F.concat(F.lit("+1"), k.cast("string"))).alias("phone_number"),
        F.col("c_mktsegment").alias("status"), _at(k % 2000).alias("created_at"), _at(k % 2000).alias("updated_at"), _text("timestamp").alias("last_login"),
    )


def user_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select(
        F.col("c_custkey").alias("address_id"), F.col("c_custkey").alias("user_id"), F.lit("home").alias("address_type"), F.col("c_name").alias("recipient_name"),
        _text("string").alias("phone_number"), F.concat(F.lit("Street "), F.col("c_custkey").cast("string")).alias("street"), _text("string").alias("ward"),
        _text("string").alias("district"), F.col("n_name").alias("city"), _text("string").alias("state"), _text("string").alias("postal_code"), F.col("r_name").alias("country"),
    )


def shops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("shop_id"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("public_shop_id"), F.col("s_name").alias("shop_name"),
        F.lower("s_name").alias("shop_slug"), F.lit("active").alias("status"), _at(F.lit(0)).alias("created_at"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    def rows(t: str, key: Column, parent: Column, name: str) -> DataFrame:
        return table(spark, sf_dir, t).select(key.cast("long").alias("category_id"), parent.cast("long").alias("parent_category_id"), F.col(name).alias("category_name"), F.lower(name).alias("slug"), F.lit(True).alias("is_active"), _at(F.lit(0)).alias("created_at"))

    return rows("region", F.col("r_regionkey"), F.lit(None), "r_name").unionByName(rows("nation", F.col("n_nationkey") + 100, F.col("n_regionkey"), "n_name"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("product_id"), (k % 25 + 100).alias("category_id"), F.concat(F.lit("P"), k.cast("string")).alias("public_product_id"), F.concat(F.lit("SKU-"), k.cast("string")).alias("product_sku"),
        F.regexp_replace("p_name", " ", "-").alias("product_slug"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("status"),
        (k % 9 == 0).alias("is_featured"), F.lit("{}").alias("attributes_json"), F.lit("[]").alias("images_json"), _at(F.lit(0)).alias("created_at"),
    )


def product_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        (k + 1000000).alias("product_variant_id"), k.alias("product_id"), F.concat(F.lit("V"), k.cast("string")).alias("public_variant_id"), F.concat(F.lit("VSKU-"), k.cast("string")).alias("variant_sku"),
        F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("variant_name"), F.lit("active").alias("status"), F.lit("{}").alias("options_json"), F.lit(True).alias("is_default"),
        F.col("p_retailprice").cast(MONEY).alias("unit_price"), _text(MONEY).alias("compare_at_price"), F.lit("USD").alias("currency"), F.col("p_size").cast("long").alias("stock_quantity"),
        F.lit(0).cast("long").alias("reserved_quantity"), _text("decimal(8,3)").alias("weight_kg"), F.lit("[]").alias("images_json"), _at(F.lit(0)).alias("created_at"),
    )


def vouchers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("o_orderpriority")
    number = F.substring(p, 1, 1).cast("long")
    return table(spark, sf_dir, "orders").select("o_orderpriority").distinct().select(
        number.alias("voucher_id"), p.alias("voucher_code"), F.concat(F.lit("Voucher "), p).alias("voucher_name"), F.when(number % 2 == 0, "percent").otherwise("fixed").alias("discount_type"),
        F.concat(F.lit('{"level":'), number.cast("string"), F.lit("}")).alias("scope_json"), _at(number * 100).alias("starts_at"), _at(number * 100 + 4000).alias("ends_at"),
        (number * 10).cast(MONEY).alias("minimum_order_amount"), (number % 3 != 0).alias("is_active"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c, total = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice").cast(MONEY)
    paid = F.when(F.col("o_orderstatus") == "F", "paid").when(F.col("o_orderstatus") == "O", "pending").otherwise("failed")
    return table(spark, sf_dir, "orders").select(
        k.alias("order_id"), c.alias("customer_id"), c.alias("shipping_address_id"), F.when(k % 5 == 0, c % 100).otherwise(c).alias("billing_address_id"),
        F.concat(F.lit("SO-"), k.cast("string")).alias("order_number"), F.col("o_orderstatus").alias("order_status"), paid.alias("payment_status"),
        F.round(total * F.lit("0.05").cast("decimal(3,2)"), 2).cast(MONEY).alias("discount_amount"), F.round(total * F.lit("0.01").cast("decimal(3,2)"), 2).cast(MONEY).alias("shipping_amount"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER))
    rows = table(spark, sf_dir, "lineitem").withColumns({
        "item_subtotal": F.col("l_extendedprice").cast(MONEY), "_d": F.col("l_discount").cast("decimal(4,2)"), "_t": F.col("l_tax").cast("decimal(4,2)"), "_n": number,
    })
    rows = rows.withColumns({"discount_amount": F.round(F.col("item_subtotal") * F.col("_d"), 2).cast(MONEY), "tax_amount": F.round(F.col("item_subtotal") * F.col("_t"), 2).cast(MONEY)})
    return rows.select(
        (F.col("l_orderkey") * 1000 + F.col("_n")).alias("order_item_id"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"), (F.col("l_partkey") + 1000000).alias("product_variant_id"),
        F.col("l_suppkey").alias("shop_id"), F.lit("USD").alias("currency"), F.col("l_quantity").cast("long").alias("quantity"), F.round(F.col("item_subtotal") / F.col("l_quantity").cast("decimal(6,0)"), 2).cast(MONEY).alias("unit_price"),
        "item_subtotal", "discount_amount", "tax_amount", (F.col("item_subtotal") - F.col("discount_amount") + F.col("tax_amount")).cast(MONEY).alias("item_total"), F.col("l_shipdate").cast("timestamp").alias("created_at"),
    )


def order_vouchers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, v = F.col("o_orderkey"), F.substring("o_orderpriority", 1, 1).cast("long")
    rows = table(spark, sf_dir, "orders").where("o_custkey % 3 <> 0")
    first = rows.select((k * 10 + 1).alias("order_voucher_id"), k.alias("order_id"), v.alias("voucher_id"))
    return first.unionByName(rows.where("o_orderkey % 7 = 0").select((k * 10 + 2).alias("order_voucher_id"), k.alias("order_id"), (v % 5 + 1).alias("voucher_id")))


# Payment methods by priority and carriers by customer.
METHODS = ("visa", "momo", "cod", "paypal", "bank_transfer")
CARRIERS = ("DHL", "UPS", "FedEx", "Post")


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    method = F.element_at(F.array(*map(F.lit, METHODS)), F.substring("o_orderpriority", 1, 1).cast("int"))
    return orders(spark, sf_dir).select("order_id", "payment_status").join(table(spark, sf_dir, "orders").where("o_orderkey % 11 <> 0").select(F.col("o_orderkey").alias("order_id"), method.alias("payment_method")), "order_id").select((F.col("order_id") + 5000000).alias("payment_id"), "order_id", "payment_method", "payment_status")


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))
    carrier = F.element_at(F.array(*map(F.lit, CARRIERS)), (F.col("o_custkey") % 4 + 1).cast("int"))
    head = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), carrier.alias("carrier"), F.col("o_orderstatus").alias("s"))
    done = F.col("s") == "F"
    return head.join(sent, "order_id").select((F.col("order_id") + 7000000).alias("shipment_id"), "order_id", "carrier", F.when(done, "delivered").otherwise("in_transit").alias("shipment_status"), F.col("first").cast("timestamp").alias("shipped_at"), F.when(done, F.col("last").cast("timestamp")).alias("delivered_at"))


BUILDERS = {f.__name__: f for f in (app_users, user_addresses, shops, categories, products, product_variants, vouchers, orders, order_items, order_vouchers, payments, shipments)}


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: f(spark, sf_dir) for n, f in BUILDERS.items()}


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change messages of ``app_users`` from the event table, in a message broker's columns."""
    op = F.when(F.col("event_type") == "signup", "r").when(F.col("event_type") == "purchase", "c").when(F.col("event_type") == "view", "u").when(F.col("event_type") == "click", "d").otherwise("x")
    amount, k, user = F.col("value").cast(MONEY).cast("string"), F.get_json_object("props", "$.k"), F.col("user_id").cast("string")
    image = F.concat(F.lit('{"user_id":'), user, F.lit(',"value":"'), amount, F.lit('","k":'), F.coalesce(k, F.lit("null")), F.lit("}"))
    source = F.when(F.col("event_id") % 97 == 0, "unknown_tbl").otherwise("app_users")
    before = F.when(op.isin("u", "d"), image).otherwise(F.lit("null"))
    after = F.when(op.isin("r", "c", "u"), image).otherwise(F.lit("null"))
    value = F.concat(F.lit('{"op":"'), op, F.lit('","ts_ms":'), F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), F.lit(',"source":{"db":"shop","schema":"public","table":"'), source, F.lit('"},"before":'), before, F.lit(',"after":'), after, F.lit("}"))
    return table(spark, sf_dir, "events").select(
        F.lit("shop.public.app_users").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit('{"user_id":'), user, F.lit("}")).alias("key"), value.alias("value"),
    )


#: The source tables and parsed events as DuckDB expressions, for oracle queries: ``WITH`` + this.
SOURCES_SQL = """
app_users AS (
  SELECT c_custkey AS user_id, 'U' || c_custkey AS public_user_id, c_name AS username, lower(replace(c_name, '#', '.')) || '@example.com' AS email, 'Customer' AS first_name,
    CASE WHEN c_custkey % 7 <> 0 THEN 'No' || c_custkey END AS last_name, CASE WHEN c_custkey % 10 <> 0 THEN '+1' || c_custkey END AS phone_number, c_mktsegment AS status,
    TIMESTAMP '1992-01-01' + to_days(CAST(c_custkey % 2000 AS INTEGER)) AS created_at FROM customer),
user_addresses AS (
  SELECT c_custkey AS address_id, c_custkey AS user_id, 'home' AS address_type, c_name AS recipient_name, 'Street ' || c_custkey AS street, n_name AS city, r_name AS country
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
shops AS (SELECT s_suppkey AS shop_id, 'S' || s_suppkey AS public_shop_id, s_name AS shop_name, lower(s_name) AS shop_slug, 'active' AS status FROM supplier),
categories AS (
  SELECT CAST(r_regionkey AS BIGINT) AS category_id, CAST(NULL AS BIGINT) AS parent_category_id, r_name AS category_name, lower(r_name) AS slug FROM region
  UNION ALL SELECT CAST(n_nationkey + 100 AS BIGINT), CAST(n_regionkey AS BIGINT), n_name, lower(n_name) FROM nation),
products AS (SELECT p_partkey AS product_id, p_partkey % 25 + 100 AS category_id, 'P' || p_partkey AS public_product_id, 'SKU-' || p_partkey AS product_sku, replace(p_name, ' ', '-') AS product_slug, p_name AS product_name, p_brand AS brand, p_type AS status, p_partkey % 9 = 0 AS is_featured FROM part),
product_variants AS (SELECT p_partkey + 1000000 AS product_variant_id, p_partkey AS product_id, 'V' || p_partkey AS public_variant_id, 'VSKU-' || p_partkey AS variant_sku, 'size ' || p_size AS variant_name, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price, CAST(p_size AS BIGINT) AS stock_quantity FROM part),
vouchers AS (
  SELECT v AS voucher_id, p AS voucher_code, 'Voucher ' || p AS voucher_name, CASE WHEN v % 2 = 0 THEN 'percent' ELSE 'fixed' END AS discount_type, '{"level":' || v || '}' AS scope_json,
    TIMESTAMP '1992-01-01' + to_days(CAST(v * 100 AS INTEGER)) AS starts_at, TIMESTAMP '1992-01-01' + to_days(CAST(v * 100 + 4000 AS INTEGER)) AS ends_at, CAST(v * 10 AS DECIMAL(12,2)) AS minimum_order_amount, v % 3 <> 0 AS is_active
  FROM (SELECT DISTINCT o_orderpriority AS p, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS v FROM orders)),
sales_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_custkey AS shipping_address_id, CASE WHEN o_orderkey % 5 = 0 THEN o_custkey % 100 ELSE o_custkey END AS billing_address_id, 'SO-' || o_orderkey AS order_number, o_orderstatus AS order_status,
    CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'failed' END AS payment_status, CAST(round(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.05 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS discount_amount,
    CAST(round(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS shipping_amount, o_orderdate AS created_at FROM orders),
line_amounts AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS item_subtotal, CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) AS discount_amount,
    CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(12,2)) AS tax_amount,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS n FROM lineitem),
order_items AS (
  SELECT l_orderkey * 1000 + n AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id, l_partkey + 1000000 AS product_variant_id, l_suppkey AS shop_id, CAST(l_quantity AS BIGINT) AS quantity, item_subtotal, discount_amount, tax_amount,
    CAST(item_subtotal - discount_amount + tax_amount AS DECIMAL(12,2)) AS item_total, l_shipdate AS created_at FROM line_amounts),
order_vouchers AS (
  SELECT o_orderkey * 10 + 1 AS order_voucher_id, o_orderkey AS order_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS voucher_id FROM orders WHERE o_custkey % 3 <> 0
  UNION ALL SELECT o_orderkey * 10 + 2, o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) % 5 + 1 FROM orders WHERE o_custkey % 3 <> 0 AND o_orderkey % 7 = 0),
payments AS (
  SELECT o_orderkey + 5000000 AS payment_id, o_orderkey AS order_id, list_extract(['visa', 'momo', 'cod', 'paypal', 'bank_transfer'], CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS payment_method,
    CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'failed' END AS payment_status FROM orders WHERE o_orderkey % 11 <> 0),
shipments AS (
  SELECT o_orderkey + 7000000 AS shipment_id, o_orderkey AS order_id, list_extract(['DHL', 'UPS', 'FedEx', 'Post'], CAST(o_custkey % 4 + 1 AS INTEGER)) AS carrier, CASE WHEN o_orderstatus = 'F' THEN 'delivered' ELSE 'in_transit' END AS shipment_status,
    f AS shipped_at, CASE WHEN o_orderstatus = 'F' THEN l END AS delivered_at FROM orders JOIN (SELECT l_orderkey, min(l_shipdate) AS f, max(l_shipdate) AS l FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey),
raw_changes AS (
  SELECT event_id, user_id, ts, CAST(value AS DECIMAL(12,2)) AS amount, json_extract_string(props, '$.k') AS k, epoch_us(ts) // 1000 AS ms,
    CASE event_type WHEN 'signup' THEN 'r' WHEN 'purchase' THEN 'c' WHEN 'view' THEN 'u' WHEN 'click' THEN 'd' ELSE 'x' END AS op, CASE WHEN event_id % 97 = 0 THEN 'unknown_tbl' ELSE 'app_users' END AS tbl FROM events),
changes AS (
  SELECT *, user_id % 4 AS part, CASE op WHEN 'r' THEN 'INSERT' WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE' ELSE 'UNKNOWN' END AS operation,
    CASE WHEN op = 'x' THEN 'unsupported_operation' WHEN tbl <> 'app_users' THEN 'unmonitored_table:' || tbl END AS error_reason, make_timestamp(ms * 1000) AS event_ts,
    '{"user_id":' || user_id || ',"value":"' || amount || '","k":' || coalesce(k, 'null') || '}' AS image FROM raw_changes)
"""
