"""Main-page exposure: how long a product has been shown, and what it did to sales."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.functions import np_round, pdiv
from shelfpulse.sources.market import on_latest


#: Days of history that the first step of a walk back reads; each further step doubles them.
FIRST_STEP = 32


def shown_products(exposures: DataFrame) -> DataFrame:
    """Products shown on the newest day, with their most popular zone."""
    return popular_zones(on_latest(exposures, "day"))


def popular_zones(newest: DataFrame) -> DataFrame:
    """The most popular zone of each product among the exposures of the newest day."""
    newest = newest.filter(F.col("product_id").isNotNull()).withColumnRenamed("day", "latest_day")
    by_popularity = Window.partitionBy("product_id").orderBy(
        F.col("popularity").desc_nulls_last(), "main_rec_category"
    )
    return (
        newest.withColumn("place", F.row_number().over(by_popularity))
        .filter(F.col("place") == 1)
        .select("product_id", "main_rec_category", "latest_day")
    )


def exposure_streak(exposures: DataFrame, shown: DataFrame | None = None) -> DataFrame:
    """Products shown on the newest day, their zone, and since when without a gap.

    With distinct days counted back from the newest, the n-th one lies in the unbroken run
    exactly if it is n-1 days before it. The window holds the days of one product. The history
    meets the few products shown now (staged, where `shown` is given) before it is shuffled.
    """
    shown = shown_products(exposures) if shown is None else shown
    days = exposures.select("product_id", "day").join(shown, "product_id").distinct()
    back = F.row_number().over(Window.partitionBy("product_id").orderBy(F.col("day").desc()))
    return (
        days.withColumn("back", back)
        .filter(F.col("day") == F.date_sub("latest_day", F.col("back") - 1))
        .groupBy("product_id", "main_rec_category", "latest_day")
        .agg(F.min("day").alias("exposure_start"))
    )


def streaks_by_steps(
    between: Callable[[date, date], DataFrame],
    shown: DataFrame,
    stage: Callable[[DataFrame], DataFrame],
    first_step: int = FIRST_STEP,
) -> DataFrame:
    """`exposure_streak` that reads the history only as far back as the longest streak.

    between(a, b): the exposures of the days `a` to `b`; `shown`: staged, as `shown_products`
    gives it; `stage` writes a small frame and reads it back. The days before the newest are read
    in steps that double. A product whose days fill a step goes on to the next one, all others are
    settled, so at most about three times the days of the longest streak are read. A step's window
    holds at most its days per product.
    """
    last = shown.agg(F.max("latest_day")).first()[0]
    open_ones = shown.withColumn("exposure_start", F.col("latest_day"))
    if last is None:
        return open_ones
    settled, step = [], first_step
    while True:
        first = last - timedelta(days=step - 1)
        days = between(first, last).select("product_id", "day")
        days = days.join(open_ones.select("product_id"), "product_id", "left_semi").distinct()
        back = F.row_number().over(Window.partitionBy("product_id").orderBy(F.col("day").desc()))
        unbroken = (
            days.withColumn("back", back)
            .filter(F.col("day") == F.date_sub(F.lit(last), F.col("back") - 1))
            .groupBy("product_id")
            .agg(F.min("day").alias("reached"))
        )
        start = F.coalesce("reached", "exposure_start")
        moved = stage(
            open_ones.join(unbroken, "product_id", "left")
            .withColumns({"exposure_start": start, "goes_on": F.col("reached").eqNullSafe(F.lit(first))})
            .drop("reached")
        )
        settled.append(moved.filter(~F.col("goes_on")).drop("goes_on"))
        open_ones = moved.filter("goes_on").drop("goes_on")
        if open_ones.isEmpty():
            return reduce(DataFrame.unionByName, settled)
        last, step = first - timedelta(days=1), step * 2


def exposure_uplift(streaks: DataFrame, daily: DataFrame, control_days: int = 7) -> DataFrame:
    """Mean daily quantity while shown against that of the days just before.

    The control sum is divided by one day more than the days it covers, as published.
    Without sales the shown mean is 0 and the control 1.
    """
    day = F.col("day")
    start, latest = F.col("exposure_start"), F.col("latest_day")
    treated = (day >= start) & (day <= latest)
    control = (day >= F.date_sub(start, control_days)) & (day < start)
    sums = (
        daily.join(streaks, "product_id")
        .filter(treated | control)
        .groupBy("product_id")
        .agg(
            F.sum(F.when(treated, F.col("qty"))).alias("shown_qty"),
            F.sum(F.when(control, F.col("qty"))).alias("control_qty"),
        )
    )
    streaks = streaks.join(sums, "product_id", "left")
    shown = F.coalesce(F.col("shown_qty") / (F.datediff(latest, start) + 1), F.lit(0.0))
    base = F.coalesce(F.col("control_qty") / (control_days + 1), F.lit(1.0))
    return streaks.select(
        "product_id",
        "main_rec_category",
        "exposure_start",
        np_round(pdiv(shown, base), 2).alias("exposure_uplift"),
    )
