"""Readers of the price tables: competitors' prices, crawl results and own prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def on_latest(df: DataFrame, day: str) -> DataFrame:
    """Rows of the newest day.

    The newest day is a scalar subquery, which Spark turns into a pushed-down filter of
    the second scan before it starts.
    """
    return df.filter(F.col(day) == df.agg(F.max(day)).scalar())


def competitor_prices(prices: DataFrame) -> DataFrame:
    return on_latest(
        prices.select("date", "competitor", "product_id", "krw_price", "usd_price"), "date"
    ).distinct()


def newest_crawls(crawls: DataFrame) -> DataFrame:
    """Newest crawl result per competitor and product, with its time.

    Of results at the same time, that with flag 0 counts; one without a flag never does. Time
    and flag are packed into one number, so a fixed-width aggregate takes the history down to one
    row per pair and task before anything is shuffled. The newest of several parts' newest
    results are those of the whole, which lets a table of them be kept.
    """
    time = F.col("update_date").cast("timestamp")
    order = F.unix_micros(time) * 2 + (F.col("sale_or_not") == 0).cast("int")
    best = F.max(order)
    return crawls.groupBy("competitor", "product_id").agg(
        F.timestamp_micros(F.shiftright(best, 1)).alias("update_date"),
        F.max_by("sale_or_not", order).alias("sale_or_not"),
    )


def with_prices(newest: DataFrame, prices: DataFrame) -> DataFrame:
    """The newest crawl results of competitors that have prices."""
    return newest.join(prices.select("competitor").distinct(), "competitor", "left_semi").select(
        "competitor", "product_id", "sale_or_not"
    )


def crawl_status(crawls: DataFrame, prices: DataFrame) -> DataFrame:
    """Newest crawl result per competitor and product, for competitors that have prices."""
    return with_prices(newest_crawls(crawls), prices)


def own_prices(items: DataFrame, prices: DataFrame) -> DataFrame:
    """Own price of the newest day; the lowest where a product has several items."""
    newest = on_latest(prices.select("item_id", "date", "krw_price"), "date")
    return (
        items.select(F.col("id").alias("item_id"), "product_id")
        .join(newest, "item_id")
        .groupBy("product_id")
        .agg(F.min("krw_price").alias("price_own"))
    )
