"""Lists without overlaps, and the placement of products on the main page."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.config import GROWTH_ZONE, RANKING_ZONE, REPURCHASE_ZONE
from shelfpulse.operators.filters import list_order, top_ranked
from shelfpulse.operators.scoring import ITEM
from shelfpulse.plans.lists import growth_list, ranking_list, repurchase_list
from shelfpulse.plans.signals import Signals
from shelfpulse.session import together


@dataclass(frozen=True)
class ListRun:
    """The staged lists of one run.

    `growth_top` holds the first growth products before the other lists were taken out.
    """

    ranking: DataFrame
    repurchase: DataFrame
    growth: DataFrame
    growth_top: DataFrame
    pin: bool


def exclusive_lists(
    signals: Signals,
    *,
    ranking_options: dict | None = None,
    repurchase_options: dict | None = None,
    growth_options: dict | None = None,
) -> ListRun:
    """Ranking, repurchase and growth list, each without the products of those before.

    The repurchase list leaves out the placed ranking products, the growth list those and
    the whole repurchase list. Everything excluded is one of a fixed number of products.
    """
    shop, stage = signals.shop, signals.staging.tables
    placed, size = shop.placed_per_list, shop.list_size
    ranking_options = {"min_turnover": 0, **(ranking_options or {}), "head_num": size}
    signals.need("all_daily", "all_barcodes", "purchase_totals")
    signals.need("cards", "weekly")
    ranked, found, grown = (
        _items(listed)
        for listed in together(
            signals.spark,
            [
                lambda: ranking_list(signals, **ranking_options),
                lambda: repurchase_list(signals, **(repurchase_options or {})),
                lambda: growth_list(signals, **(growth_options or {})),
            ],
        )
    )
    by_growth = list_order("growth_rate")
    first = stage(
        {"ranking_list": ranked, "growth_top": top_ranked(grown, placed, by_growth)}
    )
    ranking, growth_top = first["ranking_list"], first["growth_top"]
    placed_ranking = ranking.filter(F.col("rank") <= placed).select("product_id")
    left = found.join(placed_ranking, "product_id", "left_anti")
    repurchase = signals.staging.table(
        top_ranked(left, size, list_order("score")), "repurchase_list"
    )
    shown = (
        placed_ranking.union(repurchase.filter(F.col("rank") <= placed).select("product_id"))
        .union(growth_top.select("product_id"))
        .filter(F.col("product_id") == shop.pinned_product)
    )
    pin = signals.pinned_in_stock and shown.isEmpty()
    pinned_first = (F.col("product_id") == shop.pinned_product) if pin else None
    listed = placed_ranking.union(repurchase.select("product_id"))
    growth = signals.staging.table(
        top_ranked(
            grown.join(listed, "product_id", "left_anti"),
            size,
            list_order("growth_rate", pinned_first),
        ),
        "growth_list",
    )
    return ListRun(ranking, repurchase, growth, growth_top, pin)


def _items(listed: DataFrame) -> DataFrame:
    return listed.filter(F.col("row_kind") == ITEM)


def placement_list(signals: Signals, lists: ListRun, *, exclusive: bool = False) -> DataFrame:
    """Zone and location of the first products of each list.

    If the pinned product is in stock but in no zone, it takes the first growth location; the
    others move down and the last one drops out. As published, growth products are taken
    before the exclusion of the other lists; `exclusive` takes them after it.
    """
    shop = signals.shop
    growth = lists.growth if exclusive else lists.growth_top
    if lists.pin:
        growth = _pinned_first(growth, shop.pinned_product, shop.placed_per_list)
    zones = [
        (lists.ranking, RANKING_ZONE),
        (lists.repurchase, REPURCHASE_ZONE),
        (growth, GROWTH_ZONE),
    ]
    placed = None
    for frame, zone in zones:
        part = frame.filter(F.col("rank") <= shop.placed_per_list).select(
            "product_id",
            F.lit(signals.run_date).alias("date"),
            F.lit(zone).alias("main_rec_category"),
            F.col("rank").alias("location"),
        )
        placed = part if placed is None else placed.union(part)
    return placed


def _pinned_first(growth: DataFrame, pinned: int, placed: int) -> DataFrame:
    """The pinned product, then the others without the last; all of it a handful of rows."""
    top = growth.filter(F.col("rank") <= placed)
    places = F.greatest(top.agg(F.count("*")).scalar(), F.lit(1))
    others = top.filter(F.col("product_id") != pinned).select(
        "product_id", (F.row_number().over(Window.orderBy("rank")) + 1).alias("rank")
    )
    pin = top.agg(F.lit(pinned).cast("bigint").alias("product_id"), F.lit(1).alias("rank"))
    return pin.select("product_id", "rank").union(others.filter(F.col("rank") <= places))
