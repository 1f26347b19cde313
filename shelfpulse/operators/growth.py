"""Weekly, quarterly and yearly growth from daily sales."""

from __future__ import annotations

from datetime import date, timedelta

from dateutil.relativedelta import relativedelta
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.functions import np_round, pdiv, within
from shelfpulse.operators.sales import with_products


def stock_days(stock: DataFrame, barcodes: DataFrame, low: date, high: date) -> DataFrame:
    """Days on which a product had stock, from a non-zero amount of any of its barcodes.

    The history is cut to the window and to distinct barcode days before the join, so a
    barcode brings at most one row per day.
    """
    held = (
        stock.filter(within(F.col("day"), low, high))
        .filter(F.coalesce(F.col("amount") != 0, F.lit(True)))
        .select("barcode", "day")
        .distinct()
    )
    return with_products(held, barcodes).select("product_id", "day").distinct()


def zero_filled_days(daily: DataFrame, in_stock: DataFrame, low: date, high: date) -> DataFrame:
    """Daily quantities and days in stock together; days in stock without sales have 0.

    Both inputs are unique per product and day, so stacking them under one aggregate gives
    what a full outer join gives, with one shuffle and no join.
    """
    ranged = within(F.col("day"), low, high)
    sold = daily.filter(ranged).select("product_id", "day", "qty", F.lit(0).alias("stocked"))
    held = in_stock.filter(ranged).select(
        "product_id", "day", F.lit(None).cast("double").alias("qty"), F.lit(1).alias("stocked")
    )
    return (
        sold.union(held)
        .groupBy("product_id", "day")
        .agg(
            F.coalesce(F.sum("qty"), F.lit(0.0)).alias("qty"),
            (F.max("stocked") == 1).alias("stocked"),
        )
    )


def weekly_growth(
    daily: DataFrame,
    in_stock: DataFrame,
    as_of: date,
    *,
    latest_days: int = 7,
    compare_days: int = 28,
    atleast_avg_qty: float = 0,
    atleast_qty: float = 6,
) -> DataFrame:
    """Recent against earlier mean daily quantity, with zeros for days in stock unsold.

    Both ranges include both ends and share one day. Products at or below the quantity
    threshold count with their days in stock only, as zeros.
    """
    split = as_of - timedelta(days=latest_days)
    start = split - timedelta(days=compare_days)
    days = zero_filled_days(daily, in_stock, start, as_of)
    recent = within(F.col("day"), split, as_of)
    earlier = within(F.col("day"), start, split)
    sums = days.groupBy("product_id").agg(
        F.sum(F.when(recent, F.col("qty"))).alias("recent_qty"),
        F.count_if(recent).alias("recent_days"),
        F.count_if(recent & F.col("stocked")).alias("recent_stock_days"),
        F.avg(F.when(earlier, F.col("qty"))).alias("earlier_avg"),
    )
    latest = F.when(
        F.col("recent_qty") > atleast_qty, F.col("recent_qty") / F.col("recent_days")
    ).when(F.col("recent_stock_days") > 0, F.lit(0.0))
    compare = F.greatest(F.coalesce(F.col("earlier_avg"), F.lit(1.0)), F.lit(1.0))
    return (
        sums.select("product_id", latest.alias("latest"), compare.alias("compare"))
        .filter(F.col("latest") >= atleast_avg_qty)
        .select(
            "product_id",
            np_round(F.col("latest"), 2).alias("last_avg_qty"),
            np_round(F.col("compare"), 2).alias("past_avg_qty"),
            np_round(F.col("latest") / F.col("compare"), 2).alias("growth_rate"),
        )
    )


def _period_means(daily: DataFrame, as_of: date, months: int) -> tuple[Column, Column]:
    """Conditions of the current and the previous period; both leave out their first day."""
    day = F.col("day")
    middle = as_of - relativedelta(months=months)
    start = as_of - relativedelta(months=2 * months)
    return (day > middle) & (day <= as_of), (day > start) & (day <= middle)


def yearly_growth(
    daily: DataFrame,
    as_of: date,
    *,
    min_days: int = 30,
    settled_days: int = 180,
    first_days: int = 30,
) -> DataFrame:
    """This year's mean daily quantity against last year's.

    A product without sales last year is compared with its first days on sale, if these lie
    far enough back; otherwise its rate is 0. The window holds the days of one product.
    """
    this_year, last_year = _period_means(daily, as_of, 12)
    first = F.min("day").over(Window.partitionBy("product_id"))
    opening = F.col("day") <= F.date_add("first_day", first_days)
    sums = (
        daily.withColumn("first_day", first)
        .groupBy("product_id")
        .agg(
            F.count_if(this_year).alias("days"),
            F.avg(F.when(this_year, F.col("qty"))).alias("this_year_qty"),
            F.avg(F.when(last_year, F.col("qty"))).alias("last_year_qty"),
            F.avg(F.when(opening, F.col("qty"))).alias("opening_qty"),
            F.min("first_day").alias("first_day"),
        )
        .filter(F.col("days") >= min_days)
    )
    settled = F.datediff(F.lit(as_of), F.col("first_day")) >= settled_days
    base = F.coalesce(F.col("last_year_qty"), F.when(settled, F.col("opening_qty")))
    rate = np_round(pdiv(F.col("this_year_qty"), F.col("base")), 4)
    return sums.withColumn("base", base).select(
        "product_id",
        "this_year_qty",
        F.col("base").alias("last_year_qty"),
        F.coalesce(rate, F.lit(0.0)).alias("yoy_rate"),
    )


def quarterly_growth(daily: DataFrame, as_of: date, *, min_days: int = 20) -> DataFrame:
    """The last three months' mean daily quantity against the three before."""
    this_quarter, last_quarter = _period_means(daily, as_of, 3)
    sums = (
        daily.filter(within(F.col("day"), as_of - relativedelta(months=6), as_of))
        .groupBy("product_id")
        .agg(
            F.count_if(this_quarter).alias("days"),
            F.avg(F.when(this_quarter, F.col("qty"))).alias("this_quarter_qty"),
            F.avg(F.when(last_quarter, F.col("qty"))).alias("last_quarter_qty"),
        )
        .filter(F.col("days") >= min_days)
    )
    rate = np_round(pdiv(F.col("this_quarter_qty"), F.col("last_quarter_qty")), 4)
    return sums.select(
        "product_id",
        "this_quarter_qty",
        "last_quarter_qty",
        F.coalesce(rate, F.lit(0.0)).alias("qoq_rate"),
    )
