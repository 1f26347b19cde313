"""Order lines reduced to the grains that every signal is built from."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.functions import not_in_keep_null, np_round, within


def keep_categories(sales: DataFrame, excluded: Iterable[str]) -> DataFrame:
    """Drop lines of excluded main categories; lines without a category stay."""
    return sales.filter(not_in_keep_null(F.col("category_m"), excluded))


def option_days(sales: DataFrame) -> DataFrame:
    """Quantity per product option and day, with the option's descriptive columns.

    This is the only full pass over the order lines. The aggregate has fixed-width buffers,
    so it is hashed and combined before the shuffle: a product that holds a third of all
    lines sends one row per task, option and day. Names and categories are part of the key
    and hardly widen it.
    """
    keys = ["product_id", "barcode", "variant_name", "product_name", "category_m", "category_s"]
    return (
        sales.filter(F.col("product_id").isNotNull() & F.col("purchased_at").isNotNull())
        .groupBy(*keys, F.to_date("purchased_at").alias("day"))
        .agg(
            F.coalesce(F.sum("product_qty"), F.lit(0.0)).alias("qty"),
            F.max("purchased_at").alias("last_sold_at"),
        )
    )


def line_days(sales: DataFrame) -> DataFrame:
    """Quantity per product and day straight from order lines, for when nothing else needs
    the option-day rollup: the same rows as `daily_sales` with one shuffle less."""
    return (
        sales.filter(F.col("product_id").isNotNull() & F.col("purchased_at").isNotNull())
        .groupBy("product_id", F.to_date("purchased_at").alias("day"))
        .agg(F.coalesce(F.sum("product_qty"), F.lit(0.0)).alias("qty"))
    )


def daily_sales(options: DataFrame) -> DataFrame:
    """Quantity per product and day, the base of every growth signal."""
    return options.groupBy("product_id", "day").agg(F.sum("qty").alias("qty"))


def barcode_map(options: DataFrame) -> DataFrame:
    """Which product options a barcode was sold as."""
    return options.select("product_id", "barcode", "variant_name").distinct()


def latest_day(df: DataFrame, day: str = "day") -> date:
    """The as-of day: one value, so that later date ranges are literals and reach the scans."""
    return df.agg(F.max(day)).first()[0]


def with_products(barcode_days: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Attach the products of each barcode to rows that are unique per barcode and day.

    Missing barcodes match each other. They would all meet in one hash partition, so they
    are joined apart: the rows without a barcode are at most one per day, a bound that the
    calendar gives, and are broadcast to the products without a barcode.
    """
    sold_as = barcodes.select("product_id", "barcode").distinct()
    coded = barcode_days.join(sold_as, "barcode").drop("barcode")
    no_barcode = F.col("barcode").isNull()
    uncoded = sold_as.filter(no_barcode).select("product_id", F.lit(True).alias("uncoded"))
    unknown = barcode_days.filter(no_barcode).drop("barcode")
    matched = uncoded.join(F.broadcast(unknown.withColumn("uncoded", F.lit(True))), "uncoded")
    return coded.unionByName(matched.drop("uncoded"))


def last_known(options: DataFrame, attributes: Sequence[str], until: date | None = None) -> DataFrame:
    """Attributes of each product's newest sale, null values included.

    The first aggregate is hashed and reduces to distinct attribute values; only those few
    rows reach the ordering aggregate. Sales at the same time resolve to the largest values.
    """
    seen = (
        options.filter(within(F.col("day"), None, until))
        .groupBy("product_id", *attributes)
        .agg(F.max("last_sold_at").alias("seen_at"))
    )
    newest = F.max_by(F.struct(*attributes), F.struct("seen_at", *attributes)).alias("newest")
    return seen.groupBy("product_id").agg(newest).select("product_id", "newest.*")


def barcode_average(options: DataFrame, as_of: date, days: int = 90) -> DataFrame:
    """Mean daily quantity per barcode over its selling days."""
    daily = (
        options.filter(within(F.col("day"), as_of - timedelta(days=days), as_of))
        .filter(F.col("barcode").isNotNull())
        .groupBy("barcode", "day")
        .agg(F.sum("qty").alias("qty"))
    )
    return daily.groupBy("barcode").agg(F.avg("qty").alias("avg_qty"))


def recent_average(daily: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Mean daily quantity over the selling days of the last days; no zero filling."""
    return (
        daily.filter(within(F.col("day"), as_of - timedelta(days=days), as_of))
        .groupBy("product_id")
        .agg(np_round(F.avg("qty"), 2).alias("last_avg_qty"))
    )


def substitute_losers(
    options: DataFrame, substitutes: Iterable[int], run_date: date, days: int = 90
) -> DataFrame:
    """Products of a substitute group that sold less than its best seller, from the rollup.

    Ties keep all, and a member without recent sales is not a loser. Both conditions are on
    plain columns and skip most of a staged rollup at the scan.
    """
    sums = (
        options.filter(F.col("product_id").isin(list(substitutes)))
        .filter(within(F.col("day"), run_date - timedelta(days=days), None))
        .groupBy("product_id")
        .agg(F.sum("qty").alias("qty"))
    )
    best = sums.agg(F.max("qty")).scalar()
    return sums.filter(F.col("qty") != best).select("product_id")


def inactive_products(products: DataFrame, statuses: Iterable[str]) -> DataFrame:
    """Products whose status takes them out; unknown and null statuses stay in."""
    return products.filter(F.col("status").isin(list(statuses))).select("product_id").distinct()


def without_products(df: DataFrame, blocked: DataFrame) -> DataFrame:
    return df.join(blocked, "product_id", "left_anti")


def flag_sellable(df: DataFrame, blocked: DataFrame, excluded: Iterable[int]) -> DataFrame:
    """A `sellable` column: false for products that no list may use.

    Being blocked is a property of the product, so it is attached to small frames and the
    order lines need no join.
    """
    marked = blocked.select("product_id").distinct().withColumn("blocked", F.lit(True))
    free = F.col("blocked").isNull() & not_in_keep_null(F.col("product_id"), excluded)
    return df.join(marked, "product_id", "left").withColumn("sellable", free).drop("blocked")
