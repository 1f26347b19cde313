"""The three product lists, composed from signals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.functions import not_in_keep_null, steady_mean
from shelfpulse.operators import growth
from shelfpulse.operators.feedback import review_summary, search_inflow
from shelfpulse.operators.filters import exposure_ok, list_order, top_ranked, turnover_ok
from shelfpulse.operators.prices import price_columns
from shelfpulse.operators.repurchase import repurchase_index
from shelfpulse.operators.sales import recent_average
from shelfpulse.operators.scoring import ITEM, add_grades, final_score, with_benchmark
from shelfpulse.operators.stock import out_of_stock_rate
from shelfpulse.operators.trend import long_term_growth
from shelfpulse.plans.signals import Signals

STOCK_MEANS = ["opt1_share", "opt1_stock", "opt1_dsi", "opt2_share", "opt2_stock", "opt2_dsi"]

# What the ranking adds up, weighs and subtracts.
RANKING_METRICS = (
    "last_avg_qty",
    "growth_rate",
    "qoq_rate",
    "yoy_rate",
    "repurchase_index",
    "search_count",
)
RANKING_WEIGHTS = {"last_avg_qty": 4.0}
RANKING_PENALTIES = {"negative_reviews": 2.0}
REPURCHASE_METRICS = ("repurchase_rate", "repurchase_user_rate", "last_avg_qty")
REPURCHASE_WEIGHTS = {"last_avg_qty": 0.5}


def _price_cells(signals: Signals) -> list[str]:
    cells = ["price_own", *price_columns(signals.shop.competitors)]
    return [c for cell in cells for c in (cell, f"{cell}_status")]


def _stock_cells() -> list[str]:
    return [
        f"opt{place}_{part}"
        for place in (1, 2)
        for part in ("barcode", "name", "share", "stock", "dsi")
    ]


EXPOSURE_CELLS = ["main_rec_category", "exposure_start", "exposure_uplift"]


def _with_cards(df: DataFrame, signals: Signals) -> DataFrame:
    """Attach the product cards and drop excluded brands; products without a brand stay."""
    carded = df.join(signals.cards, "product_id", "left")
    return carded.filter(not_in_keep_null(F.col("brand"), signals.shop.excluded_brands))


def _weekly(signals: Signals, options: dict[str, float]) -> DataFrame:
    """Weekly growth: the shared frame, unless windows or thresholds are not the usual ones."""
    return signals.weekly_plan(**options) if options else signals.weekly


def _finish(
    items: DataFrame, means: Sequence[str], metric: str, head_num: int | None
) -> DataFrame:
    """Benchmark over all items; then all of them, or the first with their ranks."""
    listed = with_benchmark(items, means)
    if head_num is None:
        return listed
    benchmark = listed.filter(F.col("row_kind") != ITEM)
    top = top_ranked(listed.filter(F.col("row_kind") == ITEM), head_num, list_order(metric))
    return benchmark.unionByName(top, allowMissingColumns=True)


def growth_list(
    signals: Signals,
    *,
    min_turnover: float = 0,
    head_num: int | None = None,
    **growth_options: float,
) -> DataFrame:
    """Products whose sales grew fastest against the four weeks before.

    `growth_options` are those of `weekly_growth`.
    """
    exempt = signals.shop.exempt_products
    signals.need("all_daily", "cards", *([] if growth_options else ["weekly"]))
    joined = (
        _with_cards(_weekly(signals, growth_options), signals)
        .join(long_term_growth(signals.daily), "product_id", "left")
        .filter(turnover_ok(min_turnover, exempt) & exposure_ok(exempt))
    )
    items = joined.select(
        "product_id",
        "brand",
        "product_name",
        "growth_rate",
        "last_avg_qty",
        "past_avg_qty",
        "lt_growth",
        *_price_cells(signals),
        *_stock_cells(),
        *EXPOSURE_CELLS,
    )
    means = ["growth_rate", "last_avg_qty", "past_avg_qty", "lt_growth", "price_own"]
    staged = signals.staging.table(items, "growth_items")
    return _finish(staged, [*means, *STOCK_MEANS, "exposure_uplift"], "growth_rate", head_num)


def repurchase_list(
    signals: Signals,
    *,
    target_period: int = 90,
    min_repurchase: int = 30,
    min_repurchase_user: int = 10,
    latest_days: int = 7,
    min_turnover: float = 21,
    head_num: int | None = None,
) -> DataFrame:
    """Products that many customers buy again."""
    exempt = signals.shop.exempt_products
    signals.need("all_daily", "cards")
    index = repurchase_index(
        signals.purchase_totals(target_period),
        target_period,
        min_orders=min_repurchase,
        min_users=min_repurchase_user,
    )
    recent = recent_average(signals.daily, signals.as_of, latest_days)
    joined = _with_cards(index.join(recent, "product_id"), signals).filter(
        F.col("sellable") & turnover_ok(min_turnover, exempt)
    )
    graded_input = signals.staging.table(
        joined.select(
            "product_id",
            "brand",
            "product_name",
            "repurchase_index",
            "repurchase_rate",
            "repurchase_user_rate",
            "repurchase_count",
            "purchase_count",
            "repurchase_users",
            "last_avg_qty",
            "category_m",
            "category_s",
            *_price_cells(signals),
            *_stock_cells(),
            *EXPOSURE_CELLS,
        ),
        "repurchase_items",
    )
    graded = add_grades(graded_input, REPURCHASE_METRICS, weights=REPURCHASE_WEIGHTS)
    scored = final_score(graded, REPURCHASE_METRICS).filter(exposure_ok())
    means = [
        "score",
        *[f"{m}_grade" for m in REPURCHASE_METRICS],
        "repurchase_index",
        "repurchase_rate",
        "repurchase_user_rate",
        "repurchase_count",
        "purchase_count",
        "repurchase_users",
        "last_avg_qty",
        "price_own",
    ]
    return _finish(scored, [*means, *STOCK_MEANS, "exposure_uplift"], "score", head_num)


def ranking_items(
    signals: Signals,
    *,
    latest_days: int = 7,
    min_turnover: float = 21,
    negative_up_to: int = 3,
    target_period: int = 180,
    min_repurchase: int = 30,
    min_repurchase_user: int = 10,
    this_year_days: int = 30,
    this_quarter_days: int = 20,
    **growth_options: float,
) -> DataFrame:
    """All signals of the products that sell weekly and are bought again."""
    usual = latest_days == 7 and not growth_options
    signals.need("all_daily", "cards", *(["weekly"] if usual else []))
    as_of, daily, inputs = signals.as_of, signals.daily, signals.inputs
    weekly = _weekly(signals, {} if usual else {"latest_days": latest_days, **growth_options})
    index = repurchase_index(
        signals.purchase_totals(target_period),
        target_period,
        min_orders=min_repurchase,
        min_users=min_repurchase_user,
    )
    yearly = growth.yearly_growth(daily, as_of, min_days=this_year_days)
    quarterly = growth.quarterly_growth(daily, as_of, min_days=this_quarter_days)
    since = as_of - timedelta(days=latest_days + 1)
    reviews = review_summary(
        inputs.reviews.since(since), as_of, latest_days=latest_days, negative_up_to=negative_up_to
    )
    oos = out_of_stock_rate(
        inputs.stock.since(since), signals.barcodes.filter("sellable"), as_of, latest_days
    )
    searched = search_inflow(inputs.searches.since(since), as_of, latest_days)
    joined = (
        _with_cards(weekly.join(index, "product_id"), signals)
        .filter("sellable")
        .join(yearly.select("product_id", "yoy_rate"), "product_id", "left")
        .join(quarterly.select("product_id", "qoq_rate"), "product_id", "left")
        .join(reviews, "product_id", "left")
        .join(oos.select("product_id", "oos_days", "oos_rate"), "product_id", "left")
        .join(searched, "product_id", "left")
    )
    found = signals.staging.table(joined, "ranking_signals")
    # Unreviewed products get the mean rating.
    mean_rating = found.agg(steady_mean(F.col("avg_rating"))).scalar()
    zero = F.lit(0.0)
    filled = found.withColumns(
        {
            "yoy_rate": F.coalesce("yoy_rate", zero),
            "qoq_rate": F.coalesce("qoq_rate", zero),
            "category_s": F.coalesce("category_s", F.lit("-")),
            "avg_rating": F.coalesce("avg_rating", mean_rating),
            "review_count": F.coalesce(F.col("review_count").cast("double"), zero),
            "review_length": F.coalesce("review_length", zero),
            "search_count": F.coalesce(F.col("search_count").cast("double"), zero),
            "negative_reviews": F.coalesce(F.col("negative_reviews").cast("double"), zero),
            "negative_case": F.coalesce("negative_case", F.lit("-")),
        }
    )
    return filled.filter(
        turnover_ok(min_turnover, signals.shop.exempt_products)
        & F.col("product_name").isNotNull()
    )


RANKING_MEANS = [
    "last_avg_qty",
    "past_avg_qty",
    "growth_rate",
    "qoq_rate",
    "yoy_rate",
    "repurchase_index",
    "repurchase_count",
    "purchase_count",
    "repurchase_rate",
    "repurchase_users",
    "repurchase_user_rate",
    "avg_rating",
    "review_count",
    "review_length",
    "negative_reviews",
    "oos_days",
    "oos_rate",
    "search_count",
    "price_own",
    *STOCK_MEANS,
]


def ranking_list(
    signals: Signals,
    *,
    metrics: Sequence[str] = RANKING_METRICS,
    weights: Mapping[str, float] = RANKING_WEIGHTS,
    penalties: Mapping[str, float] | None = RANKING_PENALTIES,
    head_num: int | None = None,
    **thresholds,
) -> DataFrame:
    """Weekly ranking over weighted grades; the benchmark row is graded with the items."""
    items = ranking_items(signals, **thresholds)
    listed = with_benchmark(items, RANKING_MEANS)
    graded = add_grades(
        signals.staging.table(listed, "ranking_items"), metrics, weights=weights
    )
    scored = (
        final_score(graded, metrics, penalties)
        .select(
            "row_kind",
            "product_id",
            "brand",
            "product_name",
            "score",
            *[f"{m}_grade" for m in metrics],
            *_price_cells(signals),
            "last_avg_qty",
            "past_avg_qty",
            "growth_rate",
            "qoq_rate",
            "yoy_rate",
            "repurchase_index",
            "repurchase_count",
            "purchase_count",
            "repurchase_rate",
            "repurchase_users",
            "repurchase_user_rate",
            "avg_rating",
            "review_count",
            "review_length",
            "negative_reviews",
            "negative_case",
            "oos_days",
            "oos_rate",
            "search_count",
            "category_m",
            "category_s",
            *_stock_cells(),
            *EXPOSURE_CELLS,
        )
    )
    if head_num is None:
        return scored
    benchmark = scored.filter(F.col("row_kind") != ITEM)
    top = top_ranked(scored.filter(F.col("row_kind") == ITEM), head_num, list_order("score"))
    return benchmark.unionByName(top, allowMissingColumns=True)
