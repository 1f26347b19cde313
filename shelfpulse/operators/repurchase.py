"""Repurchase rates from purchase counts per product and customer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.functions import np_round, within


def purchase_counts(sales: DataFrame, as_of: date, periods: Sequence[int]) -> DataFrame:
    """Order lines per product and customer, one column `n_<days>` per look-back period.

    All periods come from one scan of the longest. Lines without a customer do not count.
    """
    day = F.to_date("purchased_at")
    longest = as_of - timedelta(days=max(periods))
    inside = within(F.col("purchased_at"), longest, None) & (
        F.col("purchased_at") < F.lit(as_of + timedelta(days=1))
    )
    counts = [
        F.count_if(day >= F.lit(as_of - timedelta(days=period))).alias(f"n_{period}")
        for period in periods
    ]
    return (
        sales.filter(inside & F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("product_id", "user_id")
        .agg(*counts)
    )


def purchase_totals(counts: DataFrame, periods: Sequence[int]) -> DataFrame:
    """Product sums of all periods; the first purchase of each customer is not a repurchase.

    Counting through the customer grain needs no distinct, and a hot product is combined
    before the shuffle.
    """
    sums = []
    for period in periods:
        n = F.col(f"n_{period}")
        sums += [
            F.sum(n).alias(f"purchase_count_{period}"),
            F.sum(F.greatest(n - 1, F.lit(0))).alias(f"repurchase_count_{period}"),
            F.count_if(n > 1).alias(f"repurchase_users_{period}"),
        ]
    return counts.groupBy("product_id").agg(*sums)


def _of_period(totals: DataFrame, period: int) -> DataFrame:
    names = ["purchase_count", "repurchase_count", "repurchase_users"]
    return totals.filter(F.col(f"purchase_count_{period}") > 0).select(
        "product_id", *[F.col(f"{name}_{period}").alias(name) for name in names]
    )


def _count_rate():
    return np_round(F.col("repurchase_count") / F.col("purchase_count"), 2)


def _user_rate():
    return np_round(F.try_divide("repurchase_users", "repurchase_count"), 2)


def _broad_enough(min_orders: int, min_users: int):
    return (F.col("repurchase_count") >= min_orders) & (F.col("repurchase_users") >= min_users)


def repurchase_rate(totals: DataFrame, period: int) -> DataFrame:
    """Share of purchases that are not a customer's first."""
    return _of_period(totals, period).select(
        "product_id",
        "repurchase_count",
        "purchase_count",
        _count_rate().alias("repurchase_rate"),
    )


def repurchase_breadth(
    totals: DataFrame, period: int, *, min_orders: int = 30, min_users: int = 10
) -> DataFrame:
    """How many different customers stand behind the repurchases: 1 is all different."""
    return (
        _of_period(totals, period)
        .filter(_broad_enough(min_orders, min_users) & (F.col("repurchase_count") > 0))
        .select(
            "product_id",
            "repurchase_users",
            "repurchase_count",
            _user_rate().alias("repurchase_user_rate"),
        )
    )


def repurchase_index(
    totals: DataFrame, period: int, *, min_orders: int = 30, min_users: int = 10
) -> DataFrame:
    """Both rates and their product, from one aggregate."""
    rates = (
        _of_period(totals, period)
        .filter(_broad_enough(min_orders, min_users) & (F.col("repurchase_count") > 0))
        .withColumn("repurchase_rate", _count_rate())
        .withColumn("repurchase_user_rate", _user_rate())
    )
    return rates.select(
        "product_id",
        "repurchase_count",
        "purchase_count",
        "repurchase_rate",
        "repurchase_users",
        "repurchase_user_rate",
        (F.col("repurchase_rate") * F.col("repurchase_user_rate")).alias("repurchase_index"),
    )
