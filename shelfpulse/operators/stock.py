"""Stock turnover, out-of-stock rate and the stock of single products."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.functions import np_round, pdiv
from shelfpulse.operators.sales import barcode_average, barcode_map, with_products


def option_stock(
    newest: DataFrame,
    options: DataFrame,
    as_of: date,
    days: int = 90,
    barcodes: DataFrame | None = None,
) -> DataFrame:
    """Stock of the newest stock day per product option, its sales share and days of supply.

    Missing barcodes have no share and drop out, so they are left out before the joins. The
    product totals are an aggregate joined back, which a product with very many options
    cannot concentrate in one task. `barcodes` is `barcode_map(options)`, where it exists.
    """
    rows = (
        newest.filter(F.col("barcode").isNotNull())
        .select("barcode", F.col("amount").alias("stock"))
        .join(barcode_average(options, as_of, days), "barcode", "left")
        .join(barcode_map(options) if barcodes is None else barcodes, "barcode")
    )
    totals = rows.groupBy("product_id").agg(F.sum("avg_qty").alias("product_avg_qty"))
    supply = pdiv(F.col("stock").cast("double"), F.coalesce("avg_qty", F.lit(1.0)))
    return rows.join(totals, "product_id").select(
        "product_id",
        "barcode",
        "variant_name",
        "stock",
        supply.alias("dsi"),
        pdiv(F.col("avg_qty"), F.col("product_avg_qty")).alias("share"),
    )


def top_two_options(rows: DataFrame) -> DataFrame:
    """The two best-selling options per product, side by side.

    The rank limit is applied before the shuffle too, so at most two rows per product and
    task are moved.
    """
    by_share = Window.partitionBy("product_id").orderBy(
        F.col("share").desc_nulls_last(), "barcode", "variant_name", "stock"
    )
    ranked = rows.withColumn("place", F.row_number().over(by_share)).filter(F.col("place") <= 2)
    columns = []
    for place in (1, 2):
        for source, target in (
            ("barcode", "barcode"),
            ("variant_name", "name"),
            ("share", "share"),
            ("stock", "stock"),
            ("dsi", "dsi"),
        ):
            value = F.max(F.when(F.col("place") == place, F.col(source)))
            if source in ("share", "dsi"):
                value = np_round(value, 2)
            if (place, source) == (2, "dsi"):
                value = F.coalesce(value, F.lit(0.0))
            columns.append(value.alias(f"opt{place}_{target}"))
    return ranked.groupBy("product_id").agg(*columns)


def stock_turnover(
    newest: DataFrame,
    options: DataFrame,
    as_of: date,
    *,
    days: int = 90,
    alias: Iterable[tuple[int, int]] = (),
    barcodes: DataFrame | None = None,
) -> DataFrame:
    """Two best-selling options with stock, days of supply and sales share per product.

    `alias` moves the stock of one product to another; shares are those before the move.
    """
    product = F.col("product_id")
    for old, new in alias:
        product = F.when(F.col("product_id") == old, F.lit(new)).otherwise(product)
    rows = option_stock(newest, options, as_of, days, barcodes)
    return top_two_options(rows.withColumn("product_id", product.cast("bigint")))


def latest_stock(stock: DataFrame) -> DataFrame:
    """The newest amount per barcode; at the same time the larger one."""
    return newest_records(stock).select("barcode", "amount")


def newest_records(stock: DataFrame) -> DataFrame:
    """The newest record per barcode; at the same time the one with the larger amount.

    The newest of several parts' newest records are those of the whole.
    """
    newest = F.max(F.struct("recorded_at", "amount"))
    return stock.groupBy("barcode").agg(newest.alias("record")).select("barcode", "record.amount", "record.recorded_at")


def any_in_stock(stock: DataFrame, barcodes: DataFrame) -> DataFrame:
    """One row: whether any of the barcodes has stock in its newest record."""
    own = stock.join(barcodes, "barcode", "left_semi")
    return latest_stock(own).agg((F.count_if(F.col("amount") > 0) > 0).alias("in_stock"))


def out_of_stock_rate(
    stock: DataFrame, barcodes: DataFrame, as_of: date, latest_days: int = 7
) -> DataFrame:
    """Share of the tracked days on which a product had nothing in stock at all.

    Amounts are summed per barcode and day before the products are attached.
    """
    since = as_of - timedelta(days=latest_days - 1)
    amounts = (
        stock.filter(F.col("day") >= F.lit(since))
        .groupBy("barcode", "day")
        .agg(F.coalesce(F.sum("amount"), F.lit(0)).alias("amount"))
    )
    per_day = (
        with_products(amounts, barcodes)
        .groupBy("product_id", "day")
        .agg(F.sum("amount").alias("amount"))
    )
    return (
        per_day.groupBy("product_id")
        .agg(
            F.count("day").alias("tracked_days"),
            F.count_if(F.col("amount") == 0).alias("oos_days"),
        )
        .withColumn("oos_rate", F.col("oos_days") / F.col("tracked_days"))
    )
