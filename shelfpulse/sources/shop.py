"""Readers of the shop's own tables: raw frames in, clean frames out.

Filters are put on raw columns wherever possible so that they reach the file scan.
"""

from __future__ import annotations

from collections.abc import Callable

from datetime import date, timedelta

from dateutil.relativedelta import relativedelta
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.functions import (
    day_from_epoch,
    epoch_of,
    one_line,
    strip_tabs,
    timestamp_from_epoch,
    within,
)


def history_start(run_date: date, months: int = 24) -> date:
    return run_date - relativedelta(months=months)


def sales_lines(sales: DataFrame, start: date, end: date) -> DataFrame:
    """Order lines bought from `start` to midnight at the beginning of `end`."""
    return sales.filter(within(F.col("purchased_at"), start, end))


def cart_rows(cart: DataFrame, start: date, end: date, shift_hours: int = 14) -> DataFrame:
    """Cart rows added on the days `start` to `end` of the server clock; the time is shifted."""
    added = F.col("timestamp")
    inside = (added >= epoch_of(start)) & (added < epoch_of(end + timedelta(days=1)))
    return cart.filter(inside).select(
        "user_id",
        "type",
        "user_type",
        "item_id",
        "item_type",
        "product_id",
        "amount",
        "price",
        day_from_epoch(added, shift_hours).alias("add_day"),
    )


def user_rows(users: DataFrame, shift_hours: int = 14) -> DataFrame:
    return users.select(
        "user_id",
        "status",
        "user_type",
        "company_id",
        timestamp_from_epoch(F.col("last_login"), shift_hours).alias("last_login"),
        day_from_epoch(F.col("timestamp"), shift_hours).alias("register_day"),
        "firstname",
        "lastname",
        "birthday",
        "age_range",
        "gender",
    )


def reviews(
    posts: DataFrame,
    ratings: DataFrame,
    messages: DataFrame,
    threads: DataFrame,
    names: DataFrame,
    *,
    language: str = "ko",
    shift_hours: int = 14,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Product reviews with rating and text.

    Posts, which callers cut to the days they need, meet the product-sized threads and names
    first. With `stage` the result is written, so its true size is known and ratings and
    messages are scanned against it rather than shuffled whole.
    """
    product_threads = threads.filter(F.col("object_type") == "P").select("thread_id", "object_id")
    named = names.filter(F.col("lang_code") == language).select(
        F.col("product_id").alias("object_id"), "product"
    )
    post = ["thread_id", "post_id"]
    own = posts.join(product_threads.join(named, "object_id"), "thread_id").select(
        *post, "object_id", "product", "timestamp", "user_id", "status"
    )
    own = stage(own, "posts") if stage else own
    return (
        own.join(ratings, post)
        .join(messages, post)
        .select(
            "post_id",
            "thread_id",
            F.col("object_id").alias("product_id"),
            "product",
            day_from_epoch(F.col("timestamp"), shift_hours).alias("post_day"),
            "user_id",
            "rating_value",
            one_line(F.col("message")).alias("message"),
            "status",
        )
    )


def product_statuses(products: DataFrame) -> DataFrame:
    return products.select("product_id", "is_edp", "status", "hash_tag")


def stock_history(stock: DataFrame, shift_hours: int = 14) -> DataFrame:
    recorded = F.col("timestamp")
    return stock.select(
        "barcode",
        "amount",
        timestamp_from_epoch(recorded, shift_hours).alias("recorded_at"),
        day_from_epoch(recorded, shift_hours).alias("day"),
    )


def brands(
    values: DataFrame, variant_names: DataFrame, *, feature: int = 19, language: str = "ko"
) -> DataFrame:
    """One brand per product: the lowest variant id that the product carries."""
    chosen = (
        values.filter((F.col("feature_id") == feature) & (F.col("lang_code") == language))
        .groupBy("product_id")
        .agg(F.min("variant_id").alias("variant_id"))
    )
    named = (
        variant_names.filter(F.col("lang_code") == language)
        .groupBy("variant_id")
        .agg(F.min("variant").alias("brand"))
    )
    return chosen.join(named, "variant_id", "left").select(
        "product_id", strip_tabs(F.col("brand")).alias("brand")
    )


def exposure_history(exposures: DataFrame) -> DataFrame:
    return exposures.select(
        "product_id", F.to_date("date").alias("day"), "popularity", "main_rec_category"
    )


def search_history(searches: DataFrame, shift_hours: int = 14) -> DataFrame:
    return searches.select(
        "idx", "product_id", day_from_epoch(F.col("timestamp"), shift_hours).alias("day")
    )


def option_barcodes(option_inventory: DataFrame, product: int) -> DataFrame:
    """The distinct barcodes of one product."""
    return option_inventory.filter(F.col("product_id") == product).select("barcode").distinct()
