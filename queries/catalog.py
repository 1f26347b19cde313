"""One registered query per operator, run over the views of the test tables."""

from __future__ import annotations

import atexit
from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace
from datetime import date, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.views import CART_END, CART_START, RUN_DATE, SHOP, Fixtures, raw_frames, raw_sales
from shelfpulse import ShopConfig, sources
from shelfpulse.functions import np_round, one_line, pdiv, steady_mean, within
from shelfpulse.operators import (
    exposure,
    feedback,
    filters,
    growth,
    prices,
    repurchase,
    sales,
    scoring,
    stock,
    trend,
)
from shelfpulse.plans import (
    Inputs,
    Signals,
    exclusive_lists,
    growth_list,
    kept_crawls,
    kept_stock,
    placement_list,
    publish_growth,
    publish_ranking,
    publish_repurchase,
    ranking_list,
    repurchase_list,
)
from shelfpulse.plans.publish import publish_placement
from shelfpulse.plans.rollup import KeptRollup
from shelfpulse.session import CHECKPOINT_DIR, Staging
from shelfpulse.sources import Tables
from shelfpulse.sources.market import on_latest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Products of the test tables in these states; a test checks that they are.
PIN_APPLIES, PIN_SOLD_OUT = 10, 22

# Before all histories, and a day in the middle of the crawl results.
EARLY, CRAWLS_SEEN = date(1900, 1, 1), date(1997, 1, 1)

# The test tables have few repurchases within 90 days.
REPURCHASE_OPTIONS = {"min_repurchase": 3, "min_repurchase_user": 2}


def query(fn: Callable[[Run], DataFrame]) -> Callable[[Run], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Run(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def own_folder(spark: SparkSession) -> str:
    """Where the session names no shared folder: beside its tables, which all executors reach."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staging"


def drop_quietly(staging: Staging) -> None:
    """At the end of the process the session may be gone already."""
    with suppress(Exception):
        staging.drop()


class Run:
    """What one query execution works on."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.fx = Fixtures(spark, sf_dir)
        # Results are read after the query returns, so what it staged goes when the process ends.
        self.staging = Staging(spark, spark.conf.get(CHECKPOINT_DIR, None) or own_folder(spark))
        atexit.register(drop_quietly, self.staging)

    @property
    def history(self) -> DataFrame:
        start = sources.history_start(RUN_DATE, SHOP.history_months)
        return sources.sales_lines(self.fx["fx_sales"], start, RUN_DATE)

    @property
    def lines(self) -> DataFrame:
        return sales.keep_categories(self.history, SHOP.excluded_categories)

    @property
    def options(self) -> DataFrame:
        return sales.option_days(self.lines)

    @property
    def daily(self) -> DataFrame:
        return sales.line_days(self.lines)

    @property
    def stock(self) -> DataFrame:
        """The stock view in the shape that the stock reader gives."""
        return self.fx["fx_stock"].select(
            "barcode", "amount", F.col("day").cast("timestamp").alias("recorded_at"), "day"
        )

    @property
    def option_inventory(self) -> DataFrame:
        return self.fx["fx_sales"].select("product_id", "barcode")

    @property
    def crawls(self) -> DataFrame:
        return sources.crawl_status(self.fx["fx_crawl"], self.competitor_prices)

    @property
    def competitor_prices(self) -> DataFrame:
        return sources.competitor_prices(self.fx["fx_cmpt"])

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        return self.staging.table(df, name)

    def staged_daily(self) -> DataFrame:
        return self.staged(self.daily, "daily")

    def from_tables(self, shop: ShopConfig = SHOP) -> Inputs:
        """The inputs as the readers make them of a folder of raw tables. Lines and orders are
        joined once, for the sales table; products, names, features and the like, which the views
        derive from the same lines, read that table."""
        fx, root = self.fx, f"{self.staging.path}/raw"
        raw_sales(fx).write.parquet(f"{root}/sales")
        sold = self.spark.read.parquet(f"{root}/sales")
        fx["fx_sales"] = sold.withColumn("purchased_at", F.col("purchased_at").cast("date"))
        for name, frame in raw_frames(fx).items():
            if name != "sales":
                frame.write.parquet(f"{root}/{name}")
        return Inputs.from_tables(Tables(self.spark, root), RUN_DATE, shop, self.staging)

    def signals_from_tables(self, shop: ShopConfig = SHOP) -> Signals:
        return Signals(self.spark, self.from_tables(shop), shop, RUN_DATE, staging=self.staging)

    def signals(self) -> Signals:
        """The inputs of a whole run; sales and stock exist as tables, as they do in a shop."""
        fx = self.fx
        sold = fx["fx_sales"].drop("line_no", "product_price", "marked_down_price", "order_id")
        tables = self.staging.tables({"sales": sold, "stock": self.stock})
        fx["fx_sales"] = tables["sales"]
        inputs = Inputs(
            sales=self.history,
            stock=sources.DayHistory(tables["stock"]),
            option_inventory=self.option_inventory,
            products=fx["fx_status"],
            brands=fx["fx_brand"],
            exposures=fx["fx_exposure"],
            reviews=sources.DayHistory(fx["fx_review"], "post_day"),
            searches=sources.DayHistory(fx["fx_search"]),
            own_prices=fx["fx_own"],
            competitor_prices=self.competitor_prices,
            crawls=self.crawls,
        )
        return Signals(self.spark, inputs, SHOP, RUN_DATE, staging=self.staging)


# --- sources ---------------------------------------------------------------------------


@query
def src_sales(run: Run) -> DataFrame:
    return run.history.drop("line_no")


@query
def src_cart(run: Run) -> DataFrame:
    return sources.cart_rows(run.fx["fx_cart"], CART_START, CART_END, SHOP.clock_shift_hours)


@query
def src_users(run: Run) -> DataFrame:
    return sources.user_rows(run.fx["fx_users"], SHOP.clock_shift_hours)


@query
def src_reviews(run: Run) -> DataFrame:
    parts = [run.fx[f"fx_{n}"] for n in ("posts", "ratings", "messages", "threads", "names")]
    return sources.reviews(*parts, language=SHOP.language, shift_hours=SHOP.clock_shift_hours)


@query
def src_brand(run: Run) -> DataFrame:
    return sources.brands(
        run.fx["fx_feature"],
        run.fx["fx_variant"],
        feature=SHOP.brand_feature,
        language=SHOP.language,
    )


@query
def src_option_barcodes(run: Run) -> DataFrame:
    return sources.option_barcodes(run.option_inventory, SHOP.pinned_product)


@query
def latest_competitor_price(run: Run) -> DataFrame:
    return sources.competitor_prices(run.fx["fx_cmpt_history"])


@query
def latest_crawl_status(run: Run) -> DataFrame:
    return run.crawls


@query
def crawl_kept(run: Run) -> DataFrame:
    """Newest crawl results from a table that an earlier run, which saw a part, has begun."""
    kept = kept_crawls(run.spark, f"{run.staging.path}/kept-crawls")
    history = sources.DayHistory(run.fx["fx_crawl"], "update_date")
    kept.update(sources.DayHistory(history.between(EARLY, CRAWLS_SEEN), "update_date"), CRAWLS_SEEN)
    newest = kept.update(history, RUN_DATE)
    return sources.with_prices(newest, run.competitor_prices)


@query
def own_price(run: Run) -> DataFrame:
    return sources.own_prices(run.fx["fx_item"], run.fx["fx_item_price"])


# --- filters and projections -----------------------------------------------------------


@query
def filter_window(run: Run) -> DataFrame:
    daily = run.staged_daily()
    as_of = sales.latest_day(daily)
    return daily.filter(within(F.col("day"), as_of - timedelta(days=7), as_of))


@query
def filter_not_in_keep_null(run: Run) -> DataFrame:
    return run.lines.groupBy("category_m").agg(F.count("*").alias("lines"))


@query
def filter_status(run: Run) -> DataFrame:
    inactive = sales.inactive_products(run.fx["fx_status"], SHOP.excluded_statuses)
    return sales.without_products(run.daily, inactive)


@query
def semi_join_recent_sellers(run: Run) -> DataFrame:
    daily = run.staged_daily()
    as_of = sales.latest_day(daily)
    recent = daily.filter(within(F.col("day"), as_of - timedelta(days=7), as_of))
    sellers = recent.groupBy("product_id").agg(F.sum("qty").alias("total")).filter("total > 6")
    return recent.join(sellers, "product_id", "left_semi")


@query
def filter_substitutes(run: Run) -> DataFrame:
    losers = sales.substitute_losers(
        run.staged(run.options, "options"), SHOP.substitutes, RUN_DATE, SHOP.substitute_days
    )
    return sales.without_products(run.daily, losers)


@query
def clean_message(run: Run) -> DataFrame:
    return run.fx["fx_messages"].select(
        "thread_id", "post_id", one_line(F.col("message")).alias("message")
    )


@query
def np_rounding(run: Run) -> DataFrame:
    ratio = F.col("marked_down_price") / F.col("product_price") * F.col("product_qty") / 8
    return run.history.select(
        "order_id", "product_id", np_round(ratio, 2).alias("r2"), np_round(ratio, 4).alias("r4")
    )


@query
def case_price_status(run: Run) -> DataFrame:
    return prices.price_status(run.competitor_prices, run.crawls)


# --- joins -----------------------------------------------------------------------------


@query
def join_full_zero_fill(run: Run) -> DataFrame:
    options = run.staged(run.options, "options")
    as_of = sales.latest_day(options)
    low = as_of - timedelta(days=35)
    held = growth.stock_days(run.stock, sales.barcode_map(options), low, as_of)
    return growth.zero_filled_days(sales.daily_sales(options), held, low, as_of)


@query
def join_left_dims(run: Run) -> DataFrame:
    options = run.staged(run.options, "options")
    sold = options.groupBy("product_id").agg(F.sum("qty").alias("qty"))
    names = sales.last_known(options, ["product_name"])
    return sold.join(names, "product_id", "left").join(run.fx["fx_brand"], "product_id", "left")


@query
def join_null_safe_barcode(run: Run) -> DataFrame:
    def some_missing(df: DataFrame) -> DataFrame:
        code = F.col("barcode")
        return df.withColumn("barcode", F.when(code.cast("bigint") % 7 != 0, code))

    amounts = (
        some_missing(run.stock)
        .groupBy("barcode", "day")
        .agg(F.sum("amount").alias("amount"))
    )
    products = some_missing(run.history.select("product_id", "barcode"))
    return sales.with_products(amounts, products)


# --- aggregates ------------------------------------------------------------------------


@query
def agg_daily_sales(run: Run) -> DataFrame:
    return run.daily


@query
def rollup_kept(run: Run) -> DataFrame:
    """Daily sales from a rollup that an earlier run, two weeks before, has begun."""
    kept = KeptRollup(run.spark, f"{run.staging.path}/kept-rollup")
    for day in (RUN_DATE - timedelta(days=14), RUN_DATE):
        start = sources.history_start(day, SHOP.history_months)
        options = kept.update(lambda a, b: sources.sales_lines(run.fx["fx_sales"], a, b), start, day)
    return sales.daily_sales(sales.keep_categories(options, SHOP.excluded_categories))


@query
def agg_barcode_avg(run: Run) -> DataFrame:
    options = run.staged(run.options, "options")
    return sales.barcode_average(options, sales.latest_day(options))


@query
def agg_windowed_avg(run: Run) -> DataFrame:
    daily = run.staged_daily()
    as_of = sales.latest_day(daily)
    windows = {f"avg_{n}": within(F.col("day"), as_of - timedelta(days=n), as_of) for n in (7, 30, 90)}
    means = [F.avg(F.when(inside, F.col("qty"))).alias(name) for name, inside in windows.items()]
    return daily.groupBy("product_id").agg(*means)


@query
def agg_distinct_users(run: Run) -> DataFrame:
    pairs = run.lines.groupBy("product_id", "user_id").agg(F.count("*").alias("n"))
    return pairs.groupBy("product_id").agg(
        F.count("user_id").alias("users"), F.sum("n").alias("lines")
    )


@query
def agg_conditional_count(run: Run) -> DataFrame:
    return run.fx["fx_review"].groupBy("product_id").agg(
        F.count_if(F.col("rating_value") <= 3).alias("negative"),
        F.count("rating_value").alias("rated"),
    )


@query
def pivot_prices(run: Run) -> DataFrame:
    statuses = prices.price_status(run.competitor_prices, run.crawls)
    return prices.pivot_prices(statuses, SHOP.competitors)


@query
def fill_null_mean(run: Run) -> DataFrame:
    ratings = run.staged(
        run.fx["fx_review"].groupBy("product_id").agg(np_round(F.avg("rating_value"), 2).alias("avg_rating")),
        "ratings",
    )
    reviewed = ratings.filter("product_id % 3 <> 0")
    mean = reviewed.agg(steady_mean(F.col("avg_rating"))).scalar()
    products = run.fx["fx_sales"].select("product_id").distinct()
    return products.join(reviewed, "product_id", "left").select(
        "product_id", np_round(F.coalesce("avg_rating", mean), 4).alias("avg_rating")
    )


@query
def mean_extremes(run: Run) -> DataFrame:
    """Means that meet infinite, very large and very small values."""
    never = F.when((F.dayofmonth("day") == 1) & (F.col("product_id") % 7 == 0), 0.0).otherwise(1.0)
    values = {
        "rate": pdiv(F.col("qty"), never),
        "huge": F.col("qty") * 2.0**64,
        "tiny": F.col("qty") / 2.0**40,
    }
    means = [steady_mean(v).alias(name) for name, v in values.items()]
    return run.staged_daily().groupBy("product_id").agg(*means)


@query
def monthly_sales(run: Run) -> DataFrame:
    return trend.monthly_sales(run.staged_daily())


# --- windows and top-k -----------------------------------------------------------------


@query
def win_latest_stock(run: Run) -> DataFrame:
    return stock.latest_stock(run.stock)


@query
def stock_kept(run: Run) -> DataFrame:
    """Newest amounts from a table that an earlier run, two weeks before, has begun."""
    kept = kept_stock(run.spark, f"{run.staging.path}/kept-stock")
    history = sources.DayHistory(run.stock)
    for day in (RUN_DATE - timedelta(days=14), RUN_DATE):
        newest = kept.update(sources.DayHistory(history.between(EARLY, day)), day)
    return newest.select("barcode", "amount")


@query
def win_top2_options(run: Run) -> DataFrame:
    options = run.staged(run.options, "options")
    newest = on_latest(run.stock, "day")
    return stock.top_two_options(
        stock.option_stock(newest, options, sales.latest_day(options))
    )


@query
def last_known_name(run: Run) -> DataFrame:
    return sales.last_known(run.options, ["product_name", "category_m", "category_s"])


@query
def win_repurchase_rows(run: Run) -> DataFrame:
    counts = repurchase.purchase_counts(run.lines, RUN_DATE, [180])
    return counts.filter("n_180 > 1").select(
        "product_id", "user_id", (F.col("n_180") - 1).alias("repurchases")
    )


@query
def topk_ranking(run: Run) -> DataFrame:
    daily = run.staged_daily()
    recent = sales.recent_average(daily, sales.latest_day(daily))
    order = filters.list_order("last_avg_qty")
    return filters.top_ranked(recent, 15, order)


# --- signals ---------------------------------------------------------------------------


@query
def stock_turnover(run: Run) -> DataFrame:
    options = run.staged(run.options, "options")
    return stock.stock_turnover(
        on_latest(run.stock, "day"), options, sales.latest_day(options), alias=SHOP.product_alias
    )


@query
def exposure_streak(run: Run) -> DataFrame:
    return exposure.exposure_streak(run.fx["fx_exposure"])


@query
def exposure_steps(run: Run) -> DataFrame:
    """The same streaks, read back in steps that begin with two days."""
    history = sources.DayHistory(run.fx["fx_exposure"])
    shown = run.staged(exposure.popular_zones(history.newest()), "shown")
    return exposure.streaks_by_steps(history.between, shown, partial(run.staged, name="streaks"), first_step=2)


@query
def exposure_uplift(run: Run) -> DataFrame:
    return exposure.exposure_uplift(exposure.exposure_streak(run.fx["fx_exposure"]), run.daily)


@query
def ltgr(run: Run) -> DataFrame:
    return trend.long_term_growth(run.staged_daily())


@query
def growth_weekly(run: Run) -> DataFrame:
    options = run.staged(run.options, "options")
    as_of = sales.latest_day(options)
    low = as_of - timedelta(days=35)
    held = growth.stock_days(run.stock, sales.barcode_map(options), low, as_of)
    return growth.weekly_growth(sales.daily_sales(options), held, as_of)


@query
def growth_yoy(run: Run) -> DataFrame:
    daily = run.staged_daily()
    return growth.yearly_growth(daily, sales.latest_day(daily))


@query
def growth_qoq(run: Run) -> DataFrame:
    daily = run.staged_daily()
    return growth.quarterly_growth(daily, sales.latest_day(daily))


@query
def recent_avg(run: Run) -> DataFrame:
    daily = run.staged_daily()
    return sales.recent_average(daily, sales.latest_day(daily))


def _totals(run: Run) -> DataFrame:
    counts = repurchase.purchase_counts(run.lines, RUN_DATE, [90, 180])
    return repurchase.purchase_totals(counts, [90, 180])


@query
def repurchase_rate(run: Run) -> DataFrame:
    return repurchase.repurchase_rate(_totals(run), 90)


@query
def repurchase_breadth(run: Run) -> DataFrame:
    return repurchase.repurchase_breadth(_totals(run), 180)


@query
def repurchase_index(run: Run) -> DataFrame:
    return repurchase.repurchase_index(_totals(run), 180)


@query
def review_summary(run: Run) -> DataFrame:
    return feedback.review_summary(run.fx["fx_review"], RUN_DATE)


@query
def oos_rate(run: Run) -> DataFrame:
    return stock.out_of_stock_rate(run.stock, run.history.select("product_id", "barcode"), RUN_DATE)


@query
def search_inflow(run: Run) -> DataFrame:
    return feedback.search_inflow(run.fx["fx_search"], RUN_DATE)


@query
def price_matrix(run: Run) -> DataFrame:
    return prices.price_matrix(
        run.fx["fx_own"], run.competitor_prices, run.crawls, SHOP.competitors
    )


@query
def price_score(run: Run) -> DataFrame:
    return prices.price_score(price_matrix(run), SHOP.competitors).select(
        "product_id", "price_score"
    )


@query
def pinned_guard(run: Run) -> DataFrame:
    barcodes = sources.option_barcodes(run.option_inventory, SHOP.pinned_product)
    in_stock = stock.any_in_stock(run.stock, barcodes)
    kept = (F.col("product_id") != SHOP.pinned_product) | in_stock.scalar()
    return run.daily.filter(kept)


# --- scores ----------------------------------------------------------------------------

GRADED = ["last_avg_qty", "past_avg_qty", "growth_rate"]


@query
def grade_scores(run: Run) -> DataFrame:
    return scoring.add_grades(run.staged(growth_weekly(run), "weekly"), GRADED).select(
        "product_id", *[f"{m}_grade" for m in GRADED]
    )


@query
def grade_reverse(run: Run) -> DataFrame:
    rates = run.staged(oos_rate(run), "rates")
    return scoring.add_grades(rates, ["oos_rate"]).select("product_id", "oos_rate_grade")


@query
def final_score(run: Run) -> DataFrame:
    weekly = run.staged(growth_weekly(run), "weekly")
    reviews = run.fx["fx_review"].groupBy("product_id").agg(
        F.count_if(F.col("rating_value") <= 3).alias("negative_reviews")
    )
    graded = scoring.add_grades(weekly, GRADED, weights={"last_avg_qty": 4})
    found = graded.join(reviews, "product_id", "left").fillna(0, ["negative_reviews"])
    return scoring.final_score(found, GRADED, {"negative_reviews": 2}).select(
        "product_id", "score"
    )


@query
def benchmark_row(run: Run) -> DataFrame:
    return scoring.with_benchmark(run.staged(growth_weekly(run), "weekly"), GRADED)


# --- lists -----------------------------------------------------------------------------


@query
def filter_turnover(run: Run) -> DataFrame:
    return stock_turnover(run).filter(
        filters.turnover_ok(2, [SHOP.pinned_product])
    ).select("product_id", "opt1_dsi", "opt2_dsi")


@query
def filter_exposure(run: Run) -> DataFrame:
    sold = run.daily.select("product_id").distinct()
    shown = sold.join(exposure_uplift(run), "product_id", "left")
    return shown.filter(filters.exposure_ok([SHOP.pinned_product]))


@query
def list_growth(run: Run) -> DataFrame:
    return growth_list(run.signals())


@query
def list_repurchase(run: Run) -> DataFrame:
    return repurchase_list(run.signals(), min_turnover=2, **REPURCHASE_OPTIONS)


@query
def list_ranking(run: Run) -> DataFrame:
    return ranking_list(run.signals(), min_turnover=0, head_num=SHOP.list_size)


def _lists(run: Run, signals: Signals | None = None):
    signals = signals or run.signals()
    options = {"min_turnover": 2, **REPURCHASE_OPTIONS}
    return signals, exclusive_lists(signals, repurchase_options=options)


@query
def lists_exclusive(run: Run) -> DataFrame:
    _, lists = _lists(run)
    named = {"ranking": lists.ranking, "repurchase": lists.repurchase, "growth": lists.growth}
    parts = [
        frame.select(F.lit(name).alias("list"), "product_id", "rank")
        for name, frame in named.items()
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query
def placement(run: Run) -> DataFrame:
    signals, lists = _lists(run)
    return publish_placement(placement_list(signals, lists))


@query
def published_ranking(run: Run) -> DataFrame:
    return publish_ranking(_lists(run)[1].ranking, RUN_DATE, SHOP)


@query
def published_repurchase(run: Run) -> DataFrame:
    return publish_repurchase(_lists(run)[1].repurchase, RUN_DATE, SHOP)


@query
def published_growth(run: Run) -> DataFrame:
    return publish_growth(_lists(run)[1].growth, RUN_DATE, SHOP)


# --- from raw tables -------------------------------------------------------------------

RECENT = RUN_DATE - timedelta(days=9)


@query
def src_products(run: Run) -> DataFrame:
    return run.from_tables().products


@query
def src_stock(run: Run) -> DataFrame:
    return run.from_tables().stock.since(RECENT).select("barcode", "amount", "day")


@query
def src_stock_newest(run: Run) -> DataFrame:
    return run.from_tables().stock.newest().select("barcode", "amount", "day")


@query
def src_exposure(run: Run) -> DataFrame:
    return run.from_tables().exposures.all()


@query
def src_search(run: Run) -> DataFrame:
    return run.from_tables().searches.since(RECENT)


@query
def list_repurchase_60(run: Run) -> DataFrame:
    """A period that the shared totals do not cover."""
    options = {"min_turnover": 2, "target_period": 60, **REPURCHASE_OPTIONS}
    return repurchase_list(run.signals_from_tables(), **options)


@query
def placement_from_tables(run: Run) -> DataFrame:
    signals, lists = _lists(run, run.signals_from_tables())
    return publish_placement(placement_list(signals, lists))


@query
def placement_exclusive(run: Run) -> DataFrame:
    signals, lists = _lists(run, run.signals_from_tables())
    return publish_placement(placement_list(signals, lists, exclusive=True))


@query
def placement_pinned(run: Run) -> DataFrame:
    """The pinned product is in stock and in no zone."""
    shop = replace(SHOP, pinned_product=PIN_APPLIES)
    signals, lists = _lists(run, run.signals_from_tables(shop))
    return publish_placement(placement_list(signals, lists))


@query
def placement_pinned_sold_out(run: Run) -> DataFrame:
    shop = replace(SHOP, pinned_product=PIN_SOLD_OUT)
    signals, lists = _lists(run, run.signals_from_tables(shop))
    return publish_placement(placement_list(signals, lists))


# Keys under the names of the coverage list.
QUERIES["np_round"] = QUERIES.pop("np_rounding")
QUERIES["placement_list"] = QUERIES.pop("placement")
