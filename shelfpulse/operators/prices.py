"""Competitor prices: status of each price, and one row per product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.config import PRICE_CRAWL_ERROR, PRICE_NOT_COLLECTED, PRICE_NOT_SOLD, PRICE_OK


def price_columns(competitors: Sequence[str]) -> list[str]:
    return [f"price_{name.lower()}" for name in competitors]


def price_status(prices: DataFrame, crawls: DataFrame) -> DataFrame:
    """Status of every competitor price or crawl result; the price itself only where it is good.

    A price cell is a number or a word; it is kept as two typed columns.
    """
    error = (F.col("krw_price") == -1) | (F.col("usd_price") == 0) | F.col("krw_price").isNull()
    status = (
        F.when(F.col("sale_or_not") == 0, PRICE_NOT_SOLD)
        .when(error, PRICE_CRAWL_ERROR)
        .otherwise(PRICE_OK)
    )
    return (
        prices.join(crawls, ["competitor", "product_id"], "full")
        .withColumn("status", status)
        .select(
            "competitor",
            "product_id",
            "status",
            F.when(F.col("status") == PRICE_OK, F.col("krw_price")).alias("price"),
        )
    )


def pivot_prices(statuses: DataFrame, competitors: Sequence[str]) -> DataFrame:
    """Per product and competitor the lowest good price and the best status.

    The competitors are listed, so every column exists and no pass is needed to find them.
    """
    rank = (
        F.when(F.col("status") == PRICE_OK, 0)
        .when(F.col("status") == PRICE_CRAWL_ERROR, 1)
        .otherwise(2)
    )
    pivoted = (
        statuses.withColumn("status_rank", rank)
        .groupBy("product_id")
        .pivot("competitor", list(competitors))
        .agg(F.min("price").alias("price"), F.min("status_rank").alias("rank"))
    )
    columns = []
    for name, column in zip(competitors, price_columns(competitors), strict=True):
        worst = F.col(f"{name}_rank")
        columns.append(F.col(f"{name}_price").alias(column))
        columns.append(
            F.when(worst == 0, PRICE_OK)
            .when(worst == 1, PRICE_CRAWL_ERROR)
            .when(worst == 2, PRICE_NOT_SOLD)
            .alias(f"{column}_status")
        )
    return pivoted.select("product_id", *columns)


def price_matrix(
    own: DataFrame,
    prices: DataFrame,
    crawls: DataFrame,
    competitors: Sequence[str],
    *,
    all_or_none: bool = True,
) -> DataFrame:
    """Own price beside those of the competitors.

    With `all_or_none`, as published, a competitor without any price on the newest day turns
    all competitor cells into crawl errors.
    """
    matrix = pivot_prices(price_status(prices, crawls), competitors)
    complete = F.lit(True)
    if all_or_none:
        found = prices.filter(F.col("competitor").isin(list(competitors)))
        complete = found.agg(F.countDistinct("competitor") == len(competitors)).scalar()
    joined = own.join(matrix, "product_id", "left").withColumn("complete", complete)
    columns = [
        F.col("price_own"),
        F.when(F.col("price_own").isNull(), PRICE_NOT_COLLECTED)
        .otherwise(PRICE_OK)
        .alias("price_own_status"),
    ]
    for column in price_columns(competitors):
        status = F.coalesce(F.col(f"{column}_status"), F.lit(PRICE_NOT_COLLECTED))
        columns.append(F.when(F.col("complete"), F.col(column)).alias(column))
        columns.append(
            F.when(F.col("complete"), status)
            .otherwise(PRICE_CRAWL_ERROR)
            .alias(f"{column}_status")
        )
    return joined.select("product_id", *columns)


def display_price(column: str) -> Column:
    """The published cell: the price, or else the word for why there is none."""
    return F.coalesce(F.col(column).cast("string"), F.col(f"{column}_status"))


def price_score(df: DataFrame, competitors: Sequence[str], rival: str = "Coupang") -> DataFrame:
    """Points for the own price: against one rival, and against the cheapest of the others.

    No price anywhere is best. The published job keeps this switched off, and so does this
    one: no list uses it.
    """
    own, main = F.col("price_own"), F.col(f"price_{rival.lower()}")
    others = [F.col(c) for c in price_columns([n for n in competitors if n != rival])]
    cheapest = F.least(*others)
    against_main = F.when(main.isNull(), 0).when(own <= main, 2).otherwise(-2)
    against_others = F.when(cheapest.isNull(), 0).when(own <= cheapest, 1).otherwise(-1)
    alone = main.isNull() & cheapest.isNull()
    score = F.when(alone, 4).otherwise(against_main + against_others)
    return df.withColumn("price_score", score.cast("double"))
