"""Calendar and category labels."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months and hours of the labels, and payment methods by group.
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
OTHER_SEASON = "Autumn"
DAY_PARTS = {"morning": (5, 11), "afternoon": (12, 16), "evening": (17, 20)}
OTHER_DAY_PART = "night"
PAYMENT_GROUPS = {
    "card": ("visa", "mastercard", "credit_card", "debit_card"),
    "wallet": ("momo", "zalopay", "vnpay", "paypal"),
    "cod": ("cod", "cash_on_delivery"),
}
OTHER_PAYMENT_GROUP = "other"


def choose(tests: list[tuple[Column, str]], otherwise: str) -> Column:
    """CASE over (condition, label) pairs."""
    out = None
    for test, label in tests:
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def season(month: Column) -> Column:
    return choose([(month.isin(*m), s) for s, m in SEASONS.items()], OTHER_SEASON)


def day_part(hour: Column) -> Column:
    return choose([(hour.between(*h), p) for p, h in DAY_PARTS.items()], OTHER_DAY_PART)


def meridiem(hour: Column) -> Column:
    return F.when(hour < 12, F.lit("AM")).otherwise(F.lit("PM"))


def payment_group(method: str) -> Column:
    return choose([(F.lower(F.col(method)).isin(*m), g) for g, m in PAYMENT_GROUPS.items()], OTHER_PAYMENT_GROUP)


def any_of(tests: list[Column]) -> Column:
    return reduce(or_, tests, F.lit(False))


def all_of(tests: list[Column]) -> Column:
    return reduce(and_, tests, F.lit(True))


def any_null(*columns: str) -> Column:
    return any_of([F.col(c).isNull() for c in columns])


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the whole is not positive or null."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0))
