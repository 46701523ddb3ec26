"""The order-line fact and the star as a whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarryline.functions.keys import UNKNOWN_KEY, date_key, time_key
from quarryline.functions.labels import safe_ratio
from quarryline.operators.scd2 import version_at
from quarryline.plans import dimensions as d

#: Tables with an order id: a scope of orders cuts them before anything else.
SCOPED = ("orders", "order_items", "order_vouchers", "payments", "shipments")


def share(amount: str, ratio: Column) -> Column:
    """A line's part of an order amount, to the cent."""
    return F.round(F.col(amount) * ratio, 2)


def allocated(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with their order's columns and their shares of the order's discount and shipping.

    The order subtotal is a window over the lines' own partitioning by order,
    so lines are shuffled once.
    """
    lines = items.withColumn("order_item_subtotal", F.sum("item_subtotal").over(Window.partitionBy("order_id")))
    head = orders.select("order_id", "customer_id", "shipping_address_id", "billing_address_id", "order_number", "order_status", "payment_status", F.col("discount_amount").alias("order_discount"), F.col("shipping_amount").alias("order_shipping"), F.col("created_at").alias("order_created_at"))
    ratio = safe_ratio(F.col("item_subtotal"), F.col("order_item_subtotal"))
    rows = lines.join(head, "order_id")
    rows = rows.withColumns({"order_discount_amount_allocated": share("order_discount", ratio), "shipping_amount_allocated": share("order_shipping", ratio)})
    return rows.withColumns({
        "total_discount_amount": F.col("discount_amount") + F.col("order_discount_amount_allocated"),
        "net_sales_amount": F.col("item_total") - F.col("order_discount_amount_allocated") + F.col("shipping_amount_allocated"),
    })


def exactly_allocated(lines: DataFrame, amount: str, out: str, keys: tuple[str, ...] = ("order_item_id",)) -> DataFrame:
    """Shares by largest remainders, which add up to the order amount to the cent.

    ``lines`` has ``order_id``, ``item_subtotal``, ``order_item_subtotal`` and
    the order's ``amount``.
    """
    order = Window.partitionBy("order_id")
    exact = safe_ratio(F.col("item_subtotal"), F.col("order_item_subtotal")) * F.col(amount) * 100
    cents = lines.withColumn("_exact", exact).withColumn("_floor", F.floor("_exact"))
    left = F.round(F.col(amount) * 100).cast("long") - F.sum("_floor").over(order)
    rank = F.row_number().over(order.orderBy((F.col("_exact") - F.col("_floor")).desc(), *keys))
    extra = F.when((F.col("order_item_subtotal") > 0) & (rank <= left), 1).otherwise(0)
    return cents.withColumn(out, ((F.col("_floor") + extra) / 100).cast("decimal(12,2)")).drop("_exact", "_floor")


def fact_sales(tables: dict[str, DataFrame], customers: DataFrame, reduce_payments: bool = False) -> DataFrame:
    """One row per order line, with the keys of all dimensions.

    Location, shop, category and product keys are source ids, and hashed keys
    are functions of their natural values, so those dimensions need no join
    for a key: a semi-check on the id keeps the key null where the dimension
    has no such row. Payments and shipments of an order multiply its lines
    unless ``reduce_payments`` takes the latest of each.
    """
    orders, items = tables["orders"], tables["order_items"]

    def ids(table: str, key: str, out: str, *more: str) -> DataFrame:
        return tables[table].select(F.col(key), F.col(key).cast("long").alias(out), *more)

    payments, shipments = tables["payments"], tables["shipments"]
    if reduce_payments:
        payments, shipments = latest_of(payments, "payment_id"), latest_of(shipments, "shipment_id")
    promotion = d.with_key(d.promotion_by_order(orders, tables["order_vouchers"], tables["vouchers"]), "promotion_key", "natural_promotion_hash").select("order_id", "promotion_key")
    payment = d.with_key(d.payment_by_order(payments), "payment_key", "natural_payment_hash").select("order_id", "payment_key")
    shipping = d.with_key(d.shipping_by_order(shipments), "shipping_key", "natural_shipping_hash").select("order_id", "shipping_key")
    customer = version_at(orders, customers, "customer_id", "source_customer_id", "created_at", "order_id", ["customer_key"], tie="customer_key")
    products = tables["products"].select("product_id", "category_id").join(ids("categories", "category_id", "category_key"), "category_id", "left")
    variants = tables["product_variants"].join(tables["products"].select("product_id"), "product_id", "left_semi").select("product_variant_id", F.col("product_variant_id").cast("long").alias("product_key"))

    # everything by order first: these joins share the lines' partitioning
    rows = allocated(items, orders).join(customer, "order_id", "left").join(promotion, "order_id", "left").join(payment, "order_id", "left").join(shipping, "order_id", "left")
    rows = rows.join(products, "product_id", "left").join(variants, "product_variant_id", "left").join(ids("shops", "shop_id", "shop_key"), "shop_id", "left")
    for side, key in (("shipping_address_id", "ship_to_location_key"), ("billing_address_id", "bill_to_location_key")):
        rows = rows.join(ids("user_addresses", "address_id", key).withColumnRenamed("address_id", side), side, "left")
    known = {k: F.coalesce(F.col(k), F.lit(UNKNOWN_KEY)).cast("long").alias(k) for k in ("promotion_key", "payment_key", "shipping_key")}
    return rows.select(
        F.col("order_item_id").cast("long").alias("sales_key"), date_key("order_created_at").alias("order_date_key"), time_key("order_created_at").alias("order_time_key"),
        "customer_key", "product_key", "shop_key", "category_key", *known.values(), "ship_to_location_key", "bill_to_location_key",
        F.col("order_id").alias("source_order_id"), F.col("order_item_id").alias("source_order_item_id"), "order_number", F.col("order_status").cast("string").alias("order_status"),
        F.col("payment_status").cast("string").alias("payment_status"), F.col("customer_id").alias("source_customer_id"), F.col("product_id").alias("source_product_id"),
        F.col("product_variant_id").alias("source_product_variant_id"), F.col("shop_id").alias("source_shop_id"), F.col("category_id").alias("source_category_id"),
        "currency", "quantity", F.col("unit_price").alias("unit_price_amount"), F.col("item_subtotal").alias("gross_sales_amount"), F.col("discount_amount").alias("line_discount_amount"),
        "order_discount_amount_allocated", "total_discount_amount", "tax_amount", "shipping_amount_allocated", "net_sales_amount", "order_created_at", F.col("created_at").alias("order_item_created_at"),
    )


def latest_of(rows: DataFrame, key: str) -> DataFrame:
    """The row with the highest key of each order."""
    return rows.groupBy("order_id").agg(F.max_by(F.struct(*rows.columns), F.col(key)).alias("_r")).select("_r.*")


def scoped(tables: dict[str, DataFrame], order_ids: DataFrame) -> dict[str, DataFrame]:
    """The tables, those by order cut to some orders: the scope meets the scans, not the finished fact."""
    return {n: t.join(order_ids, "order_id", "left_semi") if n in SCOPED else t for n, t in tables.items()}


def build_star(tables: dict[str, DataFrame], history: DataFrame | None = None, now: Column | None = None, unknown: bool = False, reduce_payments: bool = False) -> dict[str, DataFrame]:
    """All dimensions and the fact as plans; ``history`` is the stored customer dimension."""
    t = tables
    customers = d.dim_customer(t["app_users"], t["orders"])
    versions = history if history is not None else d.customer_versions(customers)
    builders: dict[str, Callable[[], DataFrame]] = {
        "dim_date": lambda: d.dim_date(t["orders"]),
        "dim_time": lambda: d.dim_time(t["orders"]),
        "dim_customer": lambda: customers,
        "dim_location": lambda: d.dim_location(t["user_addresses"]),
        "dim_shop": lambda: d.dim_shop(t["shops"]),
        "dim_category": lambda: d.dim_category(t["categories"]),
        "dim_product": lambda: d.dim_product(t["products"], t["product_variants"]),
        "dim_promotion": lambda: d.dim_promotion(d.promotion_by_order(t["orders"], t["order_vouchers"], t["vouchers"])),
        "dim_payment": lambda: d.dim_payment(d.payment_by_order(t["payments"])),
        "dim_shipping": lambda: d.dim_shipping(d.shipping_by_order(t["shipments"])),
        "fact_sales": lambda: fact_sales(t, versions, reduce_payments),
    }
    out = {n: build() for n, build in builders.items()}
    if unknown:
        out = {n: d.with_unknown(f, d.KEYS[n]) if n in d.KEYS and d.KEYS[n] in f.columns else f for n, f in out.items()}
    return {n: d.stamped(f, now) for n, f in out.items()}
