"""Filters and limits of the published lists."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def turnover_ok(min_turnover: float, bypass: Iterable[int] = ()) -> Column:
    """Enough days of supply in the two best options, or no stock record, or an exempt product."""
    supply = F.col("opt1_dsi") + F.col("opt2_dsi")
    enough = F.coalesce(supply >= min_turnover, F.lit(False))
    return enough | F.col("opt1_dsi").isNull() | _listed(bypass)


def exposure_ok(bypass: Iterable[int] = ()) -> Column:
    """Not on the main page now, or shown with at least its earlier sales, or exempt."""
    held_up = F.coalesce(F.col("exposure_uplift") >= 1, F.lit(False))
    return F.col("main_rec_category").isNull() | held_up | _listed(bypass)


def _listed(products: Iterable[int]) -> Column:
    return F.col("product_id").isin(list(products))


def list_order(metric: str, first: Column | None = None) -> list[Column]:
    """A total order: the metric, then recent sales, then the product."""
    order = [F.col(metric).desc(), F.col("last_avg_qty").desc(), F.col("product_id").asc()]
    return order if first is None else [first.desc(), *order]


def top_ranked(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first n rows with their rank.

    The limit runs in every partition before the n rows meet, and only those are numbered.
    """
    place = F.row_number().over(Window.orderBy(*order)).alias("rank")
    return df.orderBy(*order).limit(n).select("*", place)
