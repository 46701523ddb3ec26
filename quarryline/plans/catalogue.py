"""The queries of the engine and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarryline.functions import labels
from quarryline.functions.keys import date_key, natural_hash, stable_key, time_key
from quarryline.operators import cdc, impact, ledger, merge, scd2
from quarryline.operators.schema_registry import present_keys
from quarryline.operators.silver import active, one_per_key, trimmed
from quarryline.plans import dimensions as d
from quarryline.plans import fact as f
from quarryline.plans import reconcile as r
from quarryline.sources import demo
from quarryline.sources.readers import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
WITH = "WITH " + demo.SOURCES_SQL.strip()


def query(sql: str | None = None, sources: bool = False, money: tuple[str, ...] = (), times: tuple[str, ...] = (), numbers: tuple[str, ...] = ()):
    """Register a query and its SQL; ``sources`` puts the source tables before the SQL.

    So that clients of both engines read results alike, exact ``money`` columns
    leave as doubles, ``times`` as texts, and nulls of ``numbers`` as -1.
    """

    def put(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            rows = build(spark, sf_dir)
            out = {c: F.col(c).cast("double") for c in money} | {c: F.col(c).cast("string") for c in times} | {c: F.coalesce(c, F.lit(-1)) for c in numbers}
            return rows.withColumns(out) if out else rows

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[build.__name__] = run
        if sql is not None:
            text = f"{WITH}\n{sql.strip()}" if sources else sql.strip()
            out = [f"CAST({c} AS DOUBLE) AS {c}" for c in money] + [f"CAST({c} AS VARCHAR) AS {c}" for c in times] + [f"coalesce({c}, -1) AS {c}" for c in numbers]
            ORACLES[build.__name__] = f"SELECT * REPLACE ({', '.join(out)}) FROM ({text}) AS result" if out else text
        return run

    return put


# scans and projections


@query("""SELECT l_orderkey, l_partkey, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS net
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' AND l_quantity BETWEEN 5 AND 20 AND l_returnflag IN ('A', 'R')""", money=("net",))
def scan_project_filter(spark, sf_dir):
    rows = demo.table(spark, sf_dir, "lineitem").where((F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz")) & F.col("l_quantity").between(5, 20) & F.col("l_returnflag").isin("A", "R"))
    return rows.select("l_orderkey", "l_partkey", (F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)").alias("net"))


@query("SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 60 MINUTE")
def incremental_scan(spark, sf_dir):
    return incremental(demo.table(spark, sf_dir, "events"), "ts", "2024-01-20 00:00:00", 60).select("event_id", "user_id")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS n FROM lineitem) WHERE n = 1""")
def silver_trim_dedupe(spark, sf_dir):
    rows = demo.table(spark, sf_dir, "lineitem").withColumn("l_returnflag", F.concat(F.lit("  "), "l_returnflag", F.lit(" ")))
    return one_per_key(trimmed(active(rows)), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")


@query("SELECT p_partkey, sha256(concat_ws('||', coalesce(CAST(p_partkey AS VARCHAR), 'NA'), coalesce(p_name, 'NA'), coalesce(CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) END, 'NA'))) AS h FROM part")
def natural_hashes(spark, sf_dir):
    return demo.table(spark, sf_dir, "part").select("p_partkey", natural_hash("p_partkey", "p_name", F.when(F.col("p_size") > 10, F.col("p_size"))).alias("h"))


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT p_partkey) AS BIGINT) AS keys, TRUE AS positive FROM part")
def stable_keys(spark, sf_dir):
    """Stable keys have no SQL twin: their number, uniqueness and range do."""
    return demo.table(spark, sf_dir, "part").select(stable_key("p_partkey", "p_name").alias("k")).agg(F.count("k").alias("n"), F.count_distinct("k").alias("keys"), (F.min("k") > 0).alias("positive"))


@query("SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, CAST(strftime(ts, '%H%M%S') AS INTEGER) AS time_key FROM events")
def smart_keys(spark, sf_dir):
    return demo.table(spark, sf_dir, "events").select("event_id", date_key("ts").alias("date_key"), time_key("ts").alias("time_key"))


@query("""SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) <= 5 THEN 'Spring' WHEN month(o_orderdate) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season,
  o_orderstatus = 'F' AND o_totalprice >= 1000 OR o_custkey % 2 = 0 AS flagged, CASE WHEN o_custkey % 4 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) / (o_custkey % 4) AS DOUBLE) ELSE 0 END AS ratio FROM orders""")
def conditionals(spark, sf_dir):
    rows = demo.table(spark, sf_dir, "orders")
    part = (F.col("o_custkey") % 4).cast("double")
    flagged = ((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 1000)) | (F.col("o_custkey") % 2 == 0)
    return rows.select("o_orderkey", labels.season(F.month("o_orderdate")).alias("season"), flagged.alias("flagged"), labels.safe_ratio(F.col("o_totalprice").cast("decimal(12,2)").cast("double"), part).cast("double").alias("ratio"))


# dimensions


@query("""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(dayofweek(d) + 1 AS SMALLINT) AS day_of_week, dayname(d) AS day_name, CAST(day(d) AS SMALLINT) AS day_of_month, CAST(dayofyear(d) AS SMALLINT) AS day_of_year,
  CAST(weekofyear(d) AS SMALLINT) AS week_of_year, CAST(month(d) AS SMALLINT) AS month_number, monthname(d) AS month_name, CAST(quarter(d) AS SMALLINT) AS quarter_number, CAST(year(d) AS SMALLINT) AS year_number, dayofweek(d) IN (0, 6) AS is_weekend,
  last_day(d) = d AS is_month_end, CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) <= 5 THEN 'Spring' WHEN month(d) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season_name, CAST(year(d) AS SMALLINT) AS fiscal_year, CAST(quarter(d) AS SMALLINT) AS fiscal_quarter
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""", times=("full_date",))
def dim_date(spark, sf_dir):
    return d.dim_date(demo.orders(spark, sf_dir))


@query("""SELECT CAST(strftime(t, '%H%M%S') AS INTEGER) AS time_key, strftime(t, '%H:%M:%S') AS full_time, CAST(hour(t) AS SMALLINT) AS hour_24, CAST(minute(t) AS SMALLINT) AS minute_number, CAST(second(t) AS SMALLINT) AS second_number,
  CASE WHEN hour(t) < 12 THEN 'AM' ELSE 'PM' END AS am_pm, CASE WHEN hour(t) BETWEEN 5 AND 11 THEN 'morning' WHEN hour(t) BETWEEN 12 AND 16 THEN 'afternoon' WHEN hour(t) BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END AS day_part
FROM (SELECT DISTINCT date_trunc('second', CAST(ts AS TIME) + DATE '2000-01-01') AS t FROM events)""")
def dim_time(spark, sf_dir):
    return d.dim_time(demo.table(spark, sf_dir, "events"), "ts")


CUSTOMER_SQL = """, first_orders AS (SELECT o_custkey AS user_id, min(o_orderdate) AS first_order_at FROM orders GROUP BY 1),
customers AS (SELECT u.*, concat_ws(' ', first_name, last_name) AS full_name, least(created_at, first_order_at) AS start_date,
  sha256(concat_ws('||', coalesce(username, 'NA'), coalesce(email, 'NA'), coalesce(first_name, 'NA'), coalesce(last_name, 'NA'), coalesce(phone_number, 'NA'), coalesce(status, 'NA'))) AS scd_hash
  FROM app_users u LEFT JOIN first_orders USING (user_id))"""


@query(CUSTOMER_SQL + " SELECT user_id AS source_customer_id, username, full_name, phone_number, status AS customer_status, start_date, TRUE AS is_current, scd_hash FROM customers", True)
def dim_customer(spark, sf_dir):
    rows = d.dim_customer(demo.app_users(spark, sf_dir), demo.orders(spark, sf_dir))
    return rows.select("source_customer_id", "username", "full_name", "phone_number", "customer_status", F.col("start_date").cast("timestamp_ntz").alias("start_date"), "is_current", "scd_hash")


@query("SELECT address_id AS location_key, address_id AS source_address_id, user_id AS source_customer_id, recipient_name, street, city, country, sha256(concat_ws('||', CAST(address_id AS VARCHAR), CAST(user_id AS VARCHAR), street, 'NA', 'NA', coalesce(city, 'NA'), coalesce(country, 'NA'))) AS natural_location_hash FROM user_addresses", True)
def dim_location(spark, sf_dir):
    return d.dim_location(demo.user_addresses(spark, sf_dir)).select("location_key", "source_address_id", "source_customer_id", "recipient_name", "street", "city", "country", "natural_location_hash")


@query("SELECT shop_id AS shop_key, shop_id AS source_shop_id, public_shop_id, shop_name, shop_slug, status AS shop_status, TIMESTAMP '1992-01-01' AS shop_created_at FROM shops", True, times=("shop_created_at",))
def dim_shop(spark, sf_dir):
    return d.dim_shop(demo.shops(spark, sf_dir))


@query("SELECT c.category_id AS category_key, c.category_id AS source_category_id, c.parent_category_id AS source_parent_category_id, c.category_name, c.slug AS category_slug, p.category_name AS parent_category_name, TRUE AS is_active, TIMESTAMP '1992-01-01' AS category_created_at FROM categories c LEFT JOIN categories p ON c.parent_category_id = p.category_id", True, numbers=("source_parent_category_id",), times=("category_created_at",))
def dim_category(spark, sf_dir):
    return d.dim_category(demo.categories(spark, sf_dir))


@query("SELECT product_variant_id AS product_key, product_id AS source_product_id, product_variant_id AS source_product_variant_id, public_product_id, public_variant_id, product_sku, product_slug, product_name, brand, status AS product_status, is_featured, variant_sku, variant_name, unit_price AS current_unit_price, stock_quantity FROM products JOIN product_variants USING (product_id)", True, money=("current_unit_price",))
def dim_product(spark, sf_dir):
    rows = d.dim_product(demo.products(spark, sf_dir), demo.product_variants(spark, sf_dir))
    return rows.select("product_key", "source_product_id", "source_product_variant_id", "public_product_id", "public_variant_id", "product_sku", "product_slug", "product_name", "brand", "product_status", "is_featured", "variant_sku", "variant_name", "current_unit_price", "stock_quantity")


PROMOTION_SQL = """, rollup_ AS (
  SELECT order_id, CAST(count(v.voucher_id) AS INTEGER) AS voucher_count, string_agg(DISTINCT voucher_code, ',' ORDER BY voucher_code) AS voucher_codes, string_agg(DISTINCT voucher_name, ',' ORDER BY voucher_name) AS voucher_names,
    string_agg(DISTINCT discount_type, ',' ORDER BY discount_type) AS discount_types, min(scope_json) AS promotion_scope, min(starts_at) AS promotion_start_at, max(ends_at) AS promotion_end_at, min(minimum_order_amount) AS minimum_order_amount, bool_or(is_active) AS is_active, 'voucher' AS promotion_type
  FROM order_vouchers LEFT JOIN vouchers v USING (voucher_id) GROUP BY order_id),
promotion_by_order AS (
  SELECT * FROM rollup_ UNION ALL
  SELECT order_id, 0, 'NO_VOUCHER', NULL, NULL, 'none', NULL, NULL, NULL, FALSE, 'none' FROM sales_orders WHERE order_id NOT IN (SELECT order_id FROM order_vouchers)),
promotions AS (SELECT *, sha256(concat_ws('||', promotion_type, voucher_codes, coalesce(discount_types, 'NA'), coalesce(promotion_scope, 'NA'))) AS natural_promotion_hash FROM promotion_by_order)"""


@query(PROMOTION_SQL + " SELECT natural_promotion_hash, min(promotion_type) AS promotion_type, min(voucher_count) AS voucher_count, min(voucher_codes) AS voucher_codes, min(voucher_names) AS voucher_names, min(discount_types) AS discount_types, min(promotion_scope) AS promotion_scope, min(minimum_order_amount) AS minimum_order_amount, bool_or(is_active) AS is_active, min(promotion_start_at) AS promotion_start_at, max(promotion_end_at) AS promotion_end_at FROM promotions GROUP BY 1", True, money=("minimum_order_amount",), times=("promotion_start_at", "promotion_end_at"))
def dim_promotion(spark, sf_dir):
    rows = d.dim_promotion(d.promotion_by_order(demo.orders(spark, sf_dir), demo.order_vouchers(spark, sf_dir), demo.vouchers(spark, sf_dir)))
    return rows.drop("promotion_key")


@query(PROMOTION_SQL + " SELECT order_id, voucher_count, voucher_codes, promotion_start_at, promotion_end_at, natural_promotion_hash FROM promotions", True, times=("promotion_start_at", "promotion_end_at"))
def promotion_rollup(spark, sf_dir):
    rows = d.promotion_by_order(demo.orders(spark, sf_dir), demo.order_vouchers(spark, sf_dir), demo.vouchers(spark, sf_dir))
    return rows.select("order_id", "voucher_count", "voucher_codes", F.col("promotion_start_at").cast("timestamp_ntz").alias("promotion_start_at"), F.col("promotion_end_at").cast("timestamp_ntz").alias("promotion_end_at"), "natural_promotion_hash")


@query("""SELECT DISTINCT sha256(concat_ws('||', payment_method, payment_status)) AS natural_payment_hash, payment_method, CASE WHEN payment_method IN ('visa', 'mastercard', 'credit_card', 'debit_card') THEN 'card' WHEN payment_method IN ('momo', 'zalopay', 'vnpay', 'paypal') THEN 'wallet'
  WHEN payment_method IN ('cod', 'cash_on_delivery') THEN 'cod' ELSE 'other' END AS payment_method_group, payment_status, payment_status = 'paid' AS paid_flag FROM payments""", True)
def dim_payment(spark, sf_dir):
    return d.dim_payment(d.payment_by_order(demo.payments(spark, sf_dir))).drop("payment_key")


@query("SELECT sha256(concat_ws('||', carrier, shipment_status)) AS natural_shipping_hash, carrier, shipment_status, bool_or(shipped_at IS NOT NULL) AS shipped_flag, bool_or(delivered_at IS NOT NULL) AS delivered_flag FROM shipments GROUP BY 1, 2, 3", True)
def dim_shipping(spark, sf_dir):
    return d.dim_shipping(d.shipping_by_order(demo.shipments(spark, sf_dir))).drop("shipping_key")


@query("SELECT shop_id AS shop_key, shop_name FROM shops UNION ALL SELECT 0, 'Unknown'", True)
def unknown_member(spark, sf_dir):
    return d.with_unknown(d.dim_shop(demo.shops(spark, sf_dir)), "shop_key").select("shop_key", "shop_name")


# fact


@query("SELECT l_orderkey AS order_id, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS order_item_subtotal FROM lineitem GROUP BY 1", money=("order_item_subtotal",))
def order_subtotal(spark, sf_dir):
    return demo.order_items(spark, sf_dir).groupBy("order_id").agg(F.sum("item_subtotal").cast("decimal(22,2)").alias("order_item_subtotal"))


ALLOCATED_SQL = """, subtotals AS (SELECT order_id, sum(item_subtotal) AS s FROM order_items GROUP BY 1),
allocated AS (
  SELECT i.*, o.customer_id, o.shipping_address_id, o.billing_address_id, o.order_number, o.order_status, o.payment_status, o.created_at AS order_created_at,
    CASE WHEN s > 0 THEN CAST(round(o.discount_amount * (i.item_subtotal / s), 2) AS DECIMAL(12,2)) ELSE 0 END AS disc, CASE WHEN s > 0 THEN CAST(round(o.shipping_amount * (i.item_subtotal / s), 2) AS DECIMAL(12,2)) ELSE 0 END AS ship
  FROM order_items i JOIN sales_orders o USING (order_id) JOIN subtotals USING (order_id))"""


@query(ALLOCATED_SQL + " SELECT order_item_id, CAST(disc AS DECIMAL(18,2)) AS discount_share, CAST(ship AS DECIMAL(18,2)) AS shipping_share, CAST(item_total - disc + ship AS DECIMAL(18,2)) AS net FROM allocated", True, money=("discount_share", "shipping_share", "net"))
def allocation(spark, sf_dir):
    rows = f.allocated(demo.order_items(spark, sf_dir), demo.orders(spark, sf_dir))
    return rows.select("order_item_id", F.col("order_discount_amount_allocated").cast("decimal(18,2)").alias("discount_share"), F.col("shipping_amount_allocated").cast("decimal(18,2)").alias("shipping_share"), F.col("net_sales_amount").cast("decimal(18,2)").alias("net"))


@query(ALLOCATED_SQL + " SELECT order_id, CAST(max(discount_amount) AS DECIMAL(18,2)) AS shares FROM sales_orders WHERE order_id IN (SELECT order_id FROM order_items) GROUP BY 1", True, money=("shares",))
def allocation_exact(spark, sf_dir):
    """Largest-remainder shares add up to the order's amount."""
    lines = f.allocated(demo.order_items(spark, sf_dir), demo.orders(spark, sf_dir))
    return f.exactly_allocated(lines, "order_discount", "share").groupBy("order_id").agg(F.sum("share").cast("decimal(18,2)").alias("shares"))


FACT_SQL = ALLOCATED_SQL + CUSTOMER_SQL + PROMOTION_SQL + """, fact AS (
  SELECT order_item_id AS sales_key, CAST(strftime(a.order_created_at, '%Y%m%d') AS INTEGER) AS order_date_key, CAST(strftime(a.order_created_at, '%H%M%S') AS INTEGER) AS order_time_key, a.product_variant_id AS product_key, a.shop_id AS shop_key, p.category_id AS category_key,
    a.shipping_address_id AS ship_to_location_key, a.billing_address_id AS bill_to_location_key, a.order_id AS source_order_id, a.order_number, a.order_status, a.customer_id AS source_customer_id, a.quantity,
    a.item_subtotal AS gross_sales_amount, CAST(a.discount_amount + disc AS DECIMAL(18,2)) AS total_discount_amount, a.tax_amount, CAST(a.item_total - disc + ship AS DECIMAL(18,2)) AS net_sales_amount,
    c.scd_hash AS customer_hash, pr.natural_promotion_hash, pay.payment_id IS NOT NULL AS has_payment, sh.shipment_id IS NOT NULL AS has_shipping
  FROM allocated a LEFT JOIN products p USING (product_id) LEFT JOIN customers c ON a.customer_id = c.user_id AND a.order_created_at >= c.start_date LEFT JOIN promotions pr USING (order_id)
    LEFT JOIN payments pay USING (order_id) LEFT JOIN shipments sh USING (order_id))"""


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with hashed keys replaced by what they stand for, so that SQL can check it."""
    t = demo.sources(spark, sf_dir)
    customers = d.customer_versions(d.dim_customer(t["app_users"], t["orders"]))
    rows = f.fact_sales(t, customers).join(customers.select("customer_key", F.col("scd_hash").alias("customer_hash")), "customer_key", "left")
    promotions = d.dim_promotion(d.promotion_by_order(t["orders"], t["order_vouchers"], t["vouchers"])).select("promotion_key", "natural_promotion_hash")
    rows = rows.join(promotions, "promotion_key", "left").withColumns({"has_payment": F.col("payment_key") != 0, "has_shipping": F.col("shipping_key") != 0})
    return rows.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("total_discount_amount", "net_sales_amount")})


FACT_COLUMNS = ["sales_key", "order_date_key", "order_time_key", "product_key", "shop_key", "category_key", "ship_to_location_key", "bill_to_location_key", "source_order_id", "order_number", "order_status", "source_customer_id", "quantity", "gross_sales_amount", "total_discount_amount", "tax_amount", "net_sales_amount", "customer_hash", "natural_promotion_hash", "has_payment", "has_shipping"]
FACT_MONEY = ("gross_sales_amount", "total_discount_amount", "tax_amount", "net_sales_amount")


@query(FACT_SQL + f" SELECT {', '.join(FACT_COLUMNS)} FROM fact", True, money=FACT_MONEY)
def fact_sales(spark, sf_dir):
    return _fact(spark, sf_dir).select(*FACT_COLUMNS)


@query(ALLOCATED_SQL + """ SELECT CAST(strftime(order_created_at, '%Y-%m') AS VARCHAR) AS month, brand, CAST(count(*) AS BIGINT) AS lines, CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(item_subtotal) AS DECIMAL(22,2)) AS gross, CAST(sum(item_total - disc + ship) AS DECIMAL(22,2)) AS net
FROM allocated JOIN products USING (product_id) GROUP BY 1, 2""", True, money=("gross", "net"))
def sales_by_month_brand(spark, sf_dir):
    """The flagship: allocated lines by month and brand."""
    rows = f.allocated(demo.order_items(spark, sf_dir), demo.orders(spark, sf_dir)).join(demo.products(spark, sf_dir).select("product_id", "brand"), "product_id")
    return rows.groupBy(F.date_format("order_created_at", "yyyy-MM").alias("month"), "brand").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("quantity"), F.sum("item_subtotal").cast("decimal(22,2)").alias("gross"), F.sum("net_sales_amount").cast("decimal(22,2)").alias("net"))


@query("SELECT o.order_id, s.city AS ship_city, b.city AS bill_city FROM sales_orders o LEFT JOIN user_addresses s ON s.address_id = o.shipping_address_id LEFT JOIN user_addresses b ON b.address_id = o.billing_address_id", True)
def role_playing_location(spark, sf_dir):
    rows, places = demo.orders(spark, sf_dir), demo.user_addresses(spark, sf_dir)
    for side, name in (("shipping_address_id", "ship_city"), ("billing_address_id", "bill_city")):
        rows = rows.join(places.select(F.col("address_id").alias(side), F.col("city").alias(name)), side, "left")
    return rows.select("order_id", "ship_city", "bill_city")


# joins and history


VERSION_SQL = """WITH versions AS (
  SELECT user_id, event_id, event_type, ts AS start_date, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TIMESTAMP '9999-12-31') AS end_date FROM events WHERE event_type IN ('signup', 'purchase'))"""


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = demo.table(spark, sf_dir, "events").withColumn("start_date", F.col("ts").cast("timestamp")).where(F.col("event_type").isin("signup", "purchase"))
    after = F.lead("start_date").over(Window.partitionBy("user_id").orderBy("start_date", "event_id"))
    return rows.select(F.col("user_id").alias("entity"), F.col("event_id").alias("version"), "start_date", F.coalesce(after, scd2.open_end()).alias("end_date"))


@query(VERSION_SQL + " SELECT e.event_id, v.event_id AS version FROM events e LEFT JOIN versions v ON e.user_id = v.user_id AND e.ts >= v.start_date AND e.ts < v.end_date", numbers=("version",))
def point_in_time_customer(spark, sf_dir):
    facts = demo.table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("at"))
    return scd2.version_at(facts, _versions(spark, sf_dir), "user_id", "entity", "at", "event_id", ["version"], tie="version")


@query("""WITH v AS (SELECT user_id, event_id, ts, ts + to_hours(CAST(event_id % 13 AS INTEGER)) AS e FROM events)
SELECT DISTINCT b.event_id FROM v a JOIN v b ON a.user_id = b.user_id AND (a.ts, a.e, a.event_id) < (b.ts, b.e, b.event_id) AND b.ts < a.e AND b.ts < b.e""")
def interval_overlap(spark, sf_dir):
    start = F.col("ts").cast("timestamp")
    rows = demo.table(spark, sf_dir, "events").select("user_id", "event_id", start.alias("start_date"), (start + F.make_dt_interval(hours=(F.col("event_id") % 13).cast("int"))).alias("end_date"))
    return scd2.overlaps(rows, "user_id", "event_id").select("event_id")


@query("SELECT order_id FROM sales_orders WHERE order_id NOT IN (SELECT order_id FROM order_vouchers)", True)
def anti_join_no_voucher(spark, sf_dir):
    return demo.orders(spark, sf_dir).join(demo.order_vouchers(spark, sf_dir), "order_id", "left_anti").select("order_id")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def semi_join_changed(spark, sf_dir):
    changed = demo.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return demo.table(spark, sf_dir, "customer").join(changed, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("SELECT DISTINCT l_partkey AS p_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)")
def orphan_keys(spark, sf_dir):
    return r.orphans(demo.table(spark, sf_dir, "lineitem"), "l_partkey", demo.table(spark, sf_dir, "part").where("p_size <= 40"), "p_partkey")


@query("SELECT DISTINCT order_id FROM sales_orders WHERE shipping_address_id % 50 = 7 OR billing_address_id % 50 = 7", True)
def or_join_as_union(spark, sf_dir):
    addresses = demo.user_addresses(spark, sf_dir).where("address_id % 50 = 7").select("address_id")
    return impact.orders_by_address(addresses, demo.orders(spark, sf_dir)).distinct()


# change data


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.validated(cdc.parsed(cdc.normalized(demo.messages(spark, sf_dir))), ["app_users"])


@query("SELECT event_id AS _kafka_offset, part AS _kafka_partition, op, ms AS source_ts_ms, tbl AS source_table, CASE WHEN op IN ('u', 'd') THEN image END AS before_json, CASE WHEN op IN ('r', 'c', 'u') THEN image END AS after_json FROM changes", True)
def cdc_normalize(spark, sf_dir):
    return cdc.normalized(demo.messages(spark, sf_dir)).select("_kafka_offset", "_kafka_partition", "op", "source_ts_ms", "source_table", "before_json", "after_json")


@query("SELECT event_id AS _kafka_offset, operation, event_ts, sha256('shop.public.app_users||' || part || '||' || event_id) AS _cdc_event_id, error_reason IS NULL AS is_valid_event, error_reason FROM changes", True)
def cdc_parse_validate(spark, sf_dir):
    return _events(spark, sf_dir).select("_kafka_offset", "operation", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), "_cdc_event_id", "is_valid_event", "error_reason")


@query("SELECT error_reason, CAST(count(*) AS BIGINT) AS n FROM changes WHERE error_reason IS NOT NULL GROUP BY 1", True)
def cdc_dead_letters(spark, sf_dir):
    return cdc.routed(_events(spark, sf_dir))[1].groupBy("error_reason").agg(F.count(F.lit(1)).alias("n"))


LATEST_SQL = """, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_ts DESC, part DESC, event_id DESC) AS n FROM changes WHERE error_reason IS NULL) WHERE n = 1)"""
_USER = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("value", T.StringType()), T.StructField("k", T.LongType())])


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cdc.record_rows(_events(spark, sf_dir), "app_users", ["user_id"], _USER)
    return rows.withColumns({"user_id": F.col("user_id").try_cast("long"), "value": F.col("value").try_cast("decimal(12,2)")})


@query(LATEST_SQL + " SELECT user_id, event_id AS _kafka_offset, operation FROM latest", True)
def latest_event_per_key(spark, sf_dir):
    return _latest(spark, sf_dir).select("user_id", "_kafka_offset", "operation")


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demo.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.lit("0.00").cast("decimal(12,2)").alias("value"), F.lit(None).cast("long").alias("k"))


APPLY_SQL = "SELECT c_custkey AS user_id, CAST(0 AS DECIMAL(12,2)) AS value, CAST(NULL AS BIGINT) AS k, FALSE AS is_deleted FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM latest) UNION ALL SELECT user_id, amount, CAST(k AS BIGINT), operation = 'DELETE' FROM latest"


@query(LATEST_SQL + APPLY_SQL, True, money=("value",), numbers=("k",))
def cdc_apply_soft(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    after = cdc.apply_changes(_latest(spark, sf_dir), bronze, bronze, "customers", ["user_id"]).bronze
    return after.select("user_id", "value", "k", F.coalesce("is_deleted", F.lit(False)).alias("is_deleted"))


@query(LATEST_SQL + f" SELECT user_id, value, k FROM ({APPLY_SQL}) WHERE NOT is_deleted", True, money=("value",), numbers=("k",))
def cdc_apply_hard(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    return cdc.apply_changes(_latest(spark, sf_dir), bronze, bronze, "customers", ["user_id"], hard=True).bronze.select("user_id", "value", "k")


@query(LATEST_SQL + f" SELECT user_id, value, k FROM ({APPLY_SQL}) WHERE NOT is_deleted", True, money=("value",), numbers=("k",))
def cdc_apply_silver(spark, sf_dir):
    bronze = _bronze(spark, sf_dir)
    return cdc.apply_changes(_latest(spark, sf_dir), bronze, bronze, "customers", ["user_id"]).silver.select("user_id", "value", "k")


# merges


def _target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demo.table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").select("o_orderkey", "o_custkey", F.lit("old").alias("state"), F.lit(1).alias("made"))


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demo.table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey", F.lit("new").alias("state"), F.lit(2).alias("made"))


MERGE_SQL = "WITH t AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 <> 0), s AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 2 = 0)"
SOURCE_ROWS = "SELECT o_orderkey, o_custkey, 'new' AS state, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM t) THEN 1 ELSE 2 END AS made FROM s"


@query(f"{MERGE_SQL} SELECT o_orderkey, o_custkey, 'old' AS state, 1 AS made FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL {SOURCE_ROWS}")
def merge_upsert(spark, sf_dir):
    return merge.upsert(_target(spark, sf_dir), _source(spark, sf_dir), ["o_orderkey"], keep=["made"])


@query(f"{MERGE_SQL} SELECT o_orderkey, o_custkey, 'new' AS state, 2 AS made FROM s")
def merge_synchronize(spark, sf_dir):
    return merge.synchronize(_target(spark, sf_dir), _source(spark, sf_dir), ["o_orderkey"])


@query(f"{MERGE_SQL}, new_ AS (SELECT * FROM s WHERE o_custkey % 10 = 3) SELECT o_orderkey, o_custkey, 'old' AS state, 1 AS made FROM t WHERE o_custkey % 10 <> 3 AND o_orderkey NOT IN (SELECT o_orderkey FROM new_) UNION ALL SELECT o_orderkey, o_custkey, 'new', 2 FROM new_")
def merge_replace_scope(spark, sf_dir):
    scope = demo.table(spark, sf_dir, "customer").where("c_custkey % 10 = 3").select(F.col("c_custkey").alias("o_custkey"))
    return merge.replace_scope(_target(spark, sf_dir), _source(spark, sf_dir).where("o_custkey % 10 = 3"), scope, "o_custkey", ["o_orderkey"])


@query(f"{MERGE_SQL} SELECT o_orderkey, o_custkey, 'old' AS state, 1 AS made FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)")
def merge_delete_by_key(spark, sf_dir):
    return merge.delete_keys(_target(spark, sf_dir), _source(spark, sf_dir), ["o_orderkey"])


@query("""WITH e AS (SELECT user_id, ts, event_id, event_type FROM events WHERE event_type IN ('signup', 'purchase', 'view')), c AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM e),
n AS (SELECT * FROM c WHERE p IS NULL OR p <> event_type)
SELECT user_id, event_type, ts AS start_date, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), TIMESTAMP '9999-12-31') AS end_date, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current FROM n""", times=("start_date", "end_date"))
def history_from_changes(spark, sf_dir):
    """Versions of a change stream in one pass: a row per change of value."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = demo.table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "purchase", "view"))
    rows = rows.withColumn("_p", F.lag("event_type").over(order)).where(F.col("_p").isNull() | (F.col("_p") != F.col("event_type")))
    after = F.lead("ts").over(order)
    return rows.select("user_id", "event_type", F.col("ts").alias("start_date"), F.coalesce(after, F.lit(scd2.OPEN_END).cast("timestamp_ntz")).alias("end_date"), after.isNull().alias("is_current"))


def _snapshot(spark: SparkSession, sf_dir: str, days: tuple[str, str]) -> DataFrame:
    """Users' last event type of a period, as a customer snapshot."""
    rows = demo.table(spark, sf_dir, "events").where(F.col("ts").between(*[F.lit(x).cast("timestamp_ntz") for x in days]))
    last = rows.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("email"), F.max("ts").cast("timestamp").alias("source_updated_at"))
    return last.select(F.col("user_id").alias("source_customer_id"), "email", F.col("source_updated_at").alias("start_date"), "source_updated_at", natural_hash("email").alias("scd_hash"))


SCD_PERIODS = (("2024-01-01", "2024-01-03"), ("2024-01-04", "2024-01-05"), ("2024-01-06", "2024-01-09"))


@query("""WITH p AS (SELECT user_id, ts, event_id, event_type, CASE WHEN ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-03' THEN 1 WHEN ts BETWEEN TIMESTAMP '2024-01-04' AND TIMESTAMP '2024-01-05' THEN 2 WHEN ts BETWEEN TIMESTAMP '2024-01-06' AND TIMESTAMP '2024-01-09' THEN 3 END AS period FROM events),
l AS (SELECT user_id, period, max_by(event_type, (ts, event_id)) AS email, max(ts) AS seen FROM p WHERE period IS NOT NULL GROUP BY 1, 2),
c AS (SELECT *, lag(email) OVER (PARTITION BY user_id ORDER BY period) AS before FROM l), n AS (SELECT * FROM c WHERE before IS NULL OR before <> email)
SELECT user_id AS source_customer_id, email, seen AS start_date, coalesce(lead(seen) OVER (PARTITION BY user_id ORDER BY period), TIMESTAMP '9999-12-31') AS end_date, lead(seen) OVER (PARTITION BY user_id ORDER BY period) IS NULL AS is_current FROM n""", times=("start_date", "end_date"))
def scd2_history(spark, sf_dir):
    """Three snapshots merged one after another."""
    target = None
    for days in SCD_PERIODS:
        target = scd2.merge_versions(target, _snapshot(spark, sf_dir, days), ["source_customer_id"], effective="source_updated_at", key="customer_key")
    return target.select("source_customer_id", "email", F.col("start_date").cast("timestamp_ntz").alias("start_date"), F.col("end_date").cast("timestamp_ntz").alias("end_date"), "is_current")


# impact


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events of users with images before and after: each event against the user's previous one."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = demo.table(spark, sf_dir, "events").withColumn("_p", F.lag("event_type").over(order))
    image = lambda c: F.to_json(F.struct(F.col("user_id"), F.col(c).alias("status")))
    return rows.select("event_id", F.lit("app_users").alias("table_name"), F.lit("UPDATE").alias("operation"), image("_p").alias("before_json"), image("event_type").alias("after_json"), F.lit(True).alias("is_valid_event"))


@query("SELECT event_id FROM (SELECT event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE event_type IS DISTINCT FROM p")
def type2_change_detector(spark, sf_dir):
    return impact.type2_events(_pairs(spark, sf_dir)).select("event_id")


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of changes over all source tables: ids from the event table, images before and after."""
    i = F.col("event_id")
    named = {"orders": ("order_id", i * 7), "user_addresses": ("address_id", i % 50), "shops": ("shop_id", i % 3), "categories": ("category_id", i % 2 + 100), "products": ("product_id", i % 5), "product_variants": ("product_variant_id", i % 4 + 1000010), "vouchers": ("voucher_id", F.lit(9)), "app_users": ("user_id", i % 20 + 60)}
    rows = demo.table(spark, sf_dir, "events").where("event_id < 40")
    parts = []
    for t, (key, value) in named.items():
        image = F.to_json(F.struct(value.alias(key), F.lit("a").alias("status")))
        parts.append(rows.select(F.lit(t).alias("table_name"), F.lit("DELETE").alias("operation"), image.alias("before_json"), F.lit(None).cast("string").alias("after_json"), F.lit(True).alias("is_valid_event")))
    return reduce(DataFrame.unionByName, parts)


@query(""", ids AS (SELECT event_id AS i FROM events WHERE event_id < 40)
SELECT DISTINCT CAST(order_id AS BIGINT) AS order_id FROM (
  SELECT i * 7 AS order_id FROM ids
  UNION ALL SELECT order_id FROM sales_orders WHERE shipping_address_id IN (SELECT i % 50 FROM ids) OR billing_address_id IN (SELECT i % 50 FROM ids) OR customer_id IN (SELECT i % 20 + 60 FROM ids)
  UNION ALL SELECT order_id FROM order_items WHERE shop_id IN (SELECT i % 3 FROM ids) OR product_id IN (SELECT i % 5 FROM ids) OR product_variant_id IN (SELECT i % 4 + 1000010 FROM ids) OR product_id IN (SELECT product_id FROM products WHERE category_id IN (SELECT i % 2 + 100 FROM ids))
  UNION ALL SELECT order_id FROM order_vouchers WHERE voucher_id = 9)""", True)
def impacted_orders(spark, sf_dir):
    t = demo.sources(spark, sf_dir)
    return impact.impacted_orders(_changes(spark, sf_dir), t.__getitem__)


@query("SELECT product_variant_id AS source_product_variant_id FROM product_variants WHERE product_id IN (SELECT event_id % 5 FROM events WHERE event_id < 40) OR product_variant_id IN (SELECT event_id % 4 + 1000010 FROM events WHERE event_id < 40)", True)
def impacted_dimension(spark, sf_dir):
    products = d.dim_product(demo.products(spark, sf_dir), demo.product_variants(spark, sf_dir))
    return impact.impacted_dimension("dim_product", products, _changes(spark, sf_dir), products).select("source_product_variant_id")


@query(FACT_SQL + f" SELECT {', '.join(FACT_COLUMNS)} FROM fact", True, money=FACT_MONEY)
def incremental_equals_full(spark, sf_dir):
    """The fact without some orders, and then those orders' facts rebuilt from a scope: the full fact again."""
    t = demo.sources(spark, sf_dir)
    customers = d.customer_versions(d.dim_customer(t["app_users"], t["orders"]))
    scope = t["orders"].where("order_id % 100 = 1").select("order_id")
    full, part = f.fact_sales(t, customers), f.fact_sales(f.scoped(t, scope), customers)
    stale = full.withColumn("net_sales_amount", F.when(F.col("source_order_id") % 100 == 1, F.lit(0)).otherwise(F.col("net_sales_amount")).cast(full.schema["net_sales_amount"].dataType))
    rows = merge.replace_scope(stale, part, scope.withColumnRenamed("order_id", "source_order_id"), "source_order_id", ["source_order_id", "source_order_item_id"])
    rows = rows.join(customers.select("customer_key", F.col("scd_hash").alias("customer_hash")), "customer_key", "left")
    promotions = d.dim_promotion(d.promotion_by_order(t["orders"], t["order_vouchers"], t["vouchers"])).select("promotion_key", "natural_promotion_hash")
    rows = rows.join(promotions, "promotion_key", "left").withColumns({"has_payment": F.col("payment_key") != 0, "has_shipping": F.col("shipping_key") != 0})
    return rows.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("total_discount_amount", "net_sales_amount")}).select(*FACT_COLUMNS)


# control and checks


@query("SELECT 'shop.public.app_users' AS _kafka_topic, part AS _kafka_partition, min(event_id) AS min_offset, max(event_id) AS max_offset, CAST(count(*) AS BIGINT) AS event_count FROM changes GROUP BY part", True)
def batch_offset_ranges(spark, sf_dir):
    return ledger.offset_ranges(_events(spark, sf_dir))


@query("SELECT tbl AS table_name, part AS _kafka_partition, max(event_id) AS max_offset, max(event_ts) AS max_event_ts FROM changes WHERE error_reason IS NULL GROUP BY 1, 2", True)
def partition_watermarks(spark, sf_dir):
    rows = ledger.partition_watermarks(_events(spark, sf_dir))
    return rows.select("table_name", "_kafka_partition", "max_offset", F.col("max_event_ts").cast("timestamp_ntz").alias("max_event_ts"))


@query("SELECT key, bool_or(v IS NOT NULL) AS has_value FROM (SELECT unnest(json_keys(props)) AS key, json_extract_string(props, '$.' || unnest(json_keys(props))) AS v FROM events) GROUP BY 1")
def json_key_nullness(spark, sf_dir):
    return present_keys(demo.table(spark, sf_dir, "events"), "props")


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def dup_count(spark, sf_dir):
    return r.duplicated_keys(demo.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM app_users WHERE last_name IS NULL OR phone_number IS NULL", True)
def null_count(spark, sf_dir):
    return r.null_rows(demo.app_users(spark, sf_dir), ["last_name", "phone_number"])


@query(ALLOCATED_SQL + " SELECT abs(a - b) <= 0.01 AS passed, CAST(a AS DECIMAL(22,2)) AS expected, CAST(b AS DECIMAL(22,2)) AS actual FROM (SELECT sum(item_subtotal) AS a FROM order_items), (SELECT sum(item_subtotal) AS b FROM allocated)", True, money=("expected", "actual"))
def money_recon(spark, sf_dir):
    items = demo.order_items(spark, sf_dir)
    a = items.agg(F.sum("item_subtotal").alias("a"))
    b = f.allocated(items, demo.orders(spark, sf_dir)).agg(F.sum("item_subtotal").alias("b"))
    # two rows of one value each
    return a.join(b, F.lit(True)).select(r.money_close(F.col("a"), F.col("b")).alias("passed"), F.col("a").cast("decimal(22,2)").alias("expected"), F.col("b").cast("decimal(22,2)").alias("actual"))


@query("SELECT user_id AS entity, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS n FROM events GROUP BY 1 HAVING sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) <> 1")
def exactly_one_current(spark, sf_dir):
    rows = demo.table(spark, sf_dir, "events").select(F.col("user_id").alias("entity"), (F.col("event_type") == "signup").alias("is_current"))
    return r.wrong_current(rows, "entity")


@query("SELECT (SELECT max(ts) FROM events) >= (SELECT max(o_orderdate) FROM orders) AS fresh")
def freshness(spark, sf_dir):
    a = demo.table(spark, sf_dir, "events").agg(F.max("ts").alias("a"))
    return a.join(demo.table(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("b")), F.lit(True)).select((F.col("a") >= F.col("b")).alias("fresh"))


@query("SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'P' UNION SELECT c_custkey FROM customer WHERE c_nationkey < 5")
def distinct_union(spark, sf_dir):
    a = demo.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))
    return a.unionByName(demo.table(spark, sf_dir, "customer").where("c_nationkey < 5").select(F.col("c_custkey").alias("k"))).distinct()


@query("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS total FROM orders ORDER BY total DESC, o_orderkey LIMIT 25", money=("total",))
def sort_limit_topk(spark, sf_dir):
    return demo.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("total")).orderBy(F.col("total").desc(), "o_orderkey").limit(25)
