"""The reconciliation suite: forty checks in a few aggregations.

Checks of one table share one scan: counts, sums and null counts are columns of
one aggregate row, key uniqueness one grouped count per key, and the values of
all foreign keys of the fact are one table of (column, value). The result is a
DataFrame of (name, passed, expected, actual).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.functions.labels import any_null
from quarryline.operators.scd2 import overlaps
from quarryline.operators.silver import active

TOLERANCE = 0.01
# Foreign keys of the fact with their dimension and whether the unknown member is allowed.
FOREIGN_KEYS = {
    "customer_key": ("dim_customer", "customer_key", False), "product_key": ("dim_product", "product_key", False), "shop_key": ("dim_shop", "shop_key", False),
    "category_key": ("dim_category", "category_key", False), "ship_to_location_key": ("dim_location", "location_key", False), "bill_to_location_key": ("dim_location", "location_key", False),
    "order_date_key": ("dim_date", "date_key", False), "order_time_key": ("dim_time", "time_key", False),
    "promotion_key": ("dim_promotion", "promotion_key", True), "payment_key": ("dim_payment", "payment_key", True), "shipping_key": ("dim_shipping", "shipping_key", True),
}
CRITICAL = ("sales_key", "order_date_key", "order_time_key", "customer_key", "product_key", "shop_key", "category_key", "source_order_id", "source_order_item_id", "source_customer_id")
RESULT = T.StructType([T.StructField("name", T.StringType(), False), T.StructField("passed", T.BooleanType(), False), T.StructField("expected", T.StringType()), T.StructField("actual", T.StringType())])


@dataclass(frozen=True)
class Check:
    name: str
    passed: bool
    expected: str
    actual: str


def duplicated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many key values occur more than once."""
    return rows.groupBy(*keys).count().agg(F.count(F.when(F.col("count") > 1, 1)).alias("n"))


def null_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.agg(F.count(F.when(any_null(*columns), 1)).alias("n"))


def orphans(rows: DataFrame, key: str, dimension: DataFrame, dimension_key: str, unknown: bool = False) -> DataFrame:
    """Distinct key values that the dimension lacks; nulls are not orphans."""
    keys = rows.where(F.col(key).isNotNull()).select(F.col(key).alias(dimension_key)).distinct()
    if unknown:
        keys = keys.where(F.col(dimension_key) != 0)
    return keys.join(dimension.select(dimension_key), dimension_key, "left_anti")


def all_orphans(fact: DataFrame, dimensions: Callable[[str], DataFrame], keys: dict[str, tuple[str, str, bool]] | None = None) -> DataFrame:
    """(fact_column, n): how many distinct values of each foreign key its dimension lacks, from one scan of the fact."""
    keys = FOREIGN_KEYS if keys is None else keys
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("fact_column"), F.col(c).cast("long").alias("value")) for c in keys])).alias("p")
    used = fact.select(pairs).select("p.*").where("value IS NOT NULL").distinct()
    known = [dimensions(t).select(F.lit(c).alias("fact_column"), F.col(k).cast("long").alias("value")) for c, (t, k, _) in keys.items()]
    allowed = [c for c, (_, _, unknown) in keys.items() if unknown]
    left = used.join(reduce(DataFrame.unionByName, known), ["fact_column", "value"], "left_anti")
    return left.where(~(F.col("fact_column").isin(*allowed) & (F.col("value") == 0))).groupBy("fact_column").agg(F.count(F.lit(1)).alias("n"))


def is_fresh(loaded: Column, source: Column) -> Column:
    """Whether the last load is as late as the last source row; without source rows it is."""
    return source.isNull() | F.coalesce(loaded >= source, F.lit(False))


def money_close(a: Column, b: Column, tolerance: float = TOLERANCE) -> Column:
    """Whether two sums agree to the cent; no sum counts as zero."""
    return F.abs(F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))) <= F.lit(str(tolerance)).cast("decimal(12,2)")


def wrong_current(versions: DataFrame, entity: str, current: str = "is_current") -> DataFrame:
    """Entities that do not have exactly one current version."""
    return versions.groupBy(entity).agg(F.sum(F.when(F.col(current), 1).otherwise(0)).alias("n")).where("n <> 1")


def reconcile(read: Callable[[str, str], DataFrame], dead_letters: DataFrame | None = None, commits: DataFrame | None = None) -> list[Check]:
    """All checks; ``read(layer, table)`` gives a table."""
    fact, customer, product = (read("gold", t) for t in ("fact_sales", "dim_customer", "dim_product"))
    bronze = {t: active(read("bronze", t)) for t in ("orders", "order_items")}
    silver = {t: read("silver", t) for t in ("app_users", "orders", "order_items", "payments", "shipments", "product_variants")}

    def row(rows: DataFrame, **columns: Column) -> dict:
        return rows.agg(*[c.alias(n) for n, c in columns.items()]).first().asDict()

    every = F.count(F.lit(1))
    f = row(fact, n=every, orders=F.count_distinct("source_order_id"), gross=F.sum("gross_sales_amount"), tax=F.sum("tax_amount"), nulls=F.count(F.when(any_null(*CRITICAL), 1)), fresh=F.max("updated_at"))
    o = row(silver["orders"], n=every, ids=F.count_distinct("order_id"), last=F.max("created_at"), nulls=F.count(F.when(any_null("order_id"), 1)))
    i = row(silver["order_items"], n=every, orders=F.count_distinct("order_id"), gross=F.sum("item_subtotal"), tax=F.sum("tax_amount"), nulls=F.count(F.when(any_null("order_item_id"), 1)))
    c = row(customer, current=F.count(F.when(F.col("is_current"), 1)), key_nulls=F.count(F.when(any_null("customer_key"), 1)), business_nulls=F.count(F.when(F.col("is_current") & any_null("source_customer_id"), 1)))
    p = row(product, n=F.count_distinct("source_product_variant_id"), nulls=F.count(F.when(any_null("product_key"), 1)))
    out: list[Check] = []

    def check(name: str, passed: bool, expected: object, actual: object) -> None:
        out.append(Check(name, bool(passed), str(expected), str(actual)))

    def same(name: str, expected: object, actual: object) -> None:
        check(name, expected == actual, expected, actual)

    def none(name: str, actual: int) -> None:
        same(name, 0, int(actual))

    # the last checks of two tables' sums and times are one row
    spark = fact.sparkSession
    across = spark.range(1).select(
        money_close(F.lit(i["gross"]), F.lit(f["gross"])).alias("gross"), money_close(F.lit(i["tax"]), F.lit(f["tax"])).alias("tax"), is_fresh(F.lit(f["fresh"]).cast("timestamp"), F.lit(o["last"]).cast("timestamp")).alias("fresh")
    ).first()

    for t, n in (("orders", o["n"]), ("order_items", i["n"])):
        same(f"bronze_to_silver_{t}_count", bronze[t].count(), n)
    same("silver_order_items_to_fact_sales_count", i["n"], f["n"])
    same("distinct_orders_reconciled", i["orders"], f["orders"])
    none("fact_sales_business_key_unique", duplicated_keys(fact, ["source_order_id", "source_order_item_id"]).first()[0])
    none("fact_sales_critical_keys_not_null", f["nulls"])
    for name in ("gross", "tax"):
        check({"gross": "gross_sales_reconciled", "tax": "tax_amount_reconciled"}[name], across[name], i[name] or 0, f[name] or 0)
    same("dim_customer_count_reconciled", silver["app_users"].count(), c["current"])
    none("dim_customer_exactly_one_current", wrong_current(customer, "source_customer_id").count())
    none("dim_customer_intervals_do_not_overlap", overlaps(customer, "source_customer_id", "customer_key").count())
    current = customer.where("is_current")
    for name, rows, key, nulls in (("dim_customer_surrogate_key", customer, "customer_key", c["key_nulls"]), ("dim_customer_current_business_key", current, "source_customer_id", c["business_nulls"]), ("dim_product_key", product, "product_key", p["nulls"])):
        none(f"{name}_unique", duplicated_keys(rows, [key]).first()[0])
        none(f"{name}_not_null", nulls)
    missing = {r["fact_column"]: r["n"] for r in all_orphans(fact, lambda t: read("gold", t)).collect()}  # one row a foreign key
    for key in FOREIGN_KEYS:
        none(f"fact_sales_{key}_orphan_count", missing.get(key, 0))
    check("fact_sales_freshness", across["fresh"], f">= {o['last']}", f["fresh"])
    none("cdc_dead_letter_count", dead_letters.count() if dead_letters is not None else 0)
    none("cdc_failed_batch_count", commits.where(F.col("status") == "FAILED").count() if commits is not None else 0)
    same("dim_product_variant_count_reconciled", silver["product_variants"].select("product_variant_id").distinct().count(), p["n"])
    for t, key, nulls in (("orders", "order_id", o["nulls"]), ("order_items", "order_item_id", i["nulls"]), ("payments", "payment_id", None), ("shipments", "shipment_id", None)):
        none(f"silver_{t}_key_unique", duplicated_keys(silver[t], [key]).first()[0])
        none(f"silver_{t}_key_not_null", null_rows(silver[t], [key]).first()[0] if nulls is None else nulls)
    return out


def as_frame(spark: SparkSession, checks: list[Check]) -> DataFrame:
    return spark.createDataFrame([(c.name, c.passed, c.expected, c.actual) for c in checks], RESULT)
