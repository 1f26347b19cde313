"""The inputs of a run, and the shared frames that the lists are composed from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse import sources
from shelfpulse.config import ShopConfig
from shelfpulse.operators import exposure, growth, prices, repurchase, sales, stock
from shelfpulse.plans.newest import KeptNewest
from shelfpulse.plans.rollup import KeptRollup
from shelfpulse.session import Staging


@dataclass(frozen=True)
class Inputs:
    """Clean input frames, as the readers in `shelfpulse.sources` return them.

    Stock, exposures, reviews and searches are histories, read as far back as each signal needs;
    exposures may also be a plain frame.
    """

    sales: DataFrame
    stock: sources.History
    option_inventory: DataFrame
    products: DataFrame
    brands: DataFrame
    exposures: sources.History | DataFrame
    reviews: sources.History
    searches: sources.History
    own_prices: DataFrame
    competitor_prices: DataFrame
    crawls: DataFrame
    #: Option days of all order lines, kept between runs; without it they are aggregated anew.
    option_days: DataFrame | None = None
    #: The newest stock record per barcode, kept between runs; without it all records are read.
    newest_stock: DataFrame | None = None

    @classmethod
    def from_tables(
        cls,
        tables: sources.Tables,
        run_date: date,
        shop: ShopConfig,
        staging: Staging | None = None,
        kept: KeptRollup | None = None,
        stock_state: KeptNewest | None = None,
        crawl_state: KeptNewest | None = None,
    ) -> Inputs:
        """Readers over raw tables. With `staging`, small results that several frames or joins
        need are written once. With `kept`, the rollup of earlier runs is brought up to date, and
        only the order lines of new days are aggregated. `stock_state` and `crawl_state` do the same for
        the newest stock record per barcode and the newest crawl result per pair. Of tables laid
        out in folders by day, the newest day is read from the newest folder alone."""
        load, shift = tables.load, shop.clock_shift_hours
        start = sources.history_start(run_date, shop.history_months)

        def newest(name: str) -> DataFrame:
            """Rows among which those of the newest day are."""
            found = tables.newest(name)
            return load(name) if found is None else found

        competitor_prices = sources.competitor_prices(newest("competitor_prices"))
        if staging:
            competitor_prices = staging.table(competitor_prices, "competitor_prices")

        def lines(since: date, until: date) -> DataFrame:
            return sources.sales_lines(load("sales", since, until), since, until)

        stock_history = sources.EpochHistory(
            partial(load, "stock"),
            lambda raw: sources.stock_history(raw, shift),
            shift,
            partial(tables.newest, "stock"),
        )
        if crawl_state:
            crawl_history = sources.DatedHistory(partial(load, "crawls"), lambda raw: raw, "update_date")
            crawls = sources.with_prices(crawl_state.update(crawl_history, run_date), competitor_prices)
        else:
            crawls = sources.crawl_status(load("crawls"), competitor_prices)
        return cls(
            newest_stock=stock_state.update(stock_history, run_date) if stock_state else None,
            option_days=kept.update(lines, start, run_date) if kept else None,
            sales=lines(start, run_date),
            stock=stock_history,
            option_inventory=load("option_inventory"),
            products=sources.product_statuses(load("products")),
            brands=sources.brands(
                load("feature_values"),
                load("variant_names"),
                feature=shop.brand_feature,
                language=shop.language,
            ),
            exposures=sources.DatedHistory(
                partial(load, "exposures"),
                sources.exposure_history,
                recent=partial(tables.newest, "exposures"),
            ),
            reviews=sources.EpochHistory(
                partial(load, "posts"),
                lambda posts: sources.reviews(
                    posts,
                    load("ratings"),
                    load("messages"),
                    load("threads"),
                    load("product_names"),
                    language=shop.language,
                    shift_hours=shift,
                    stage=staging.table if staging else None,
                ),
                shift,
            ),
            searches=sources.EpochHistory(
                partial(load, "searches"), lambda raw: sources.search_history(raw, shift), shift
            ),
            own_prices=sources.own_prices(load("items"), newest("item_prices")),
            competitor_prices=competitor_prices,
            crawls=crawls,
        )


class Signals:
    """Frames that several lists share, each staged on first use.

    The order lines are read in full once, for the option-day rollup, and once more from the
    first repurchase period on. Daily sales and the barcodes of products come from the rollup;
    everything else comes from these. `need` stages several frames at the same time.
    """

    def __init__(
        self,
        spark: SparkSession,
        inputs: Inputs,
        shop: ShopConfig,
        run_date: date,
        *,
        today: date | None = None,
        staging: Staging | None = None,
        periods: tuple[int, ...] = (90, 180),
    ):
        self.spark, self.inputs, self.shop = spark, inputs, shop
        self.run_date, self.today, self.periods = run_date, today, periods
        self.staging = staging or Staging(spark)
        self._staged: dict[str, DataFrame] = {}
        self._plans = {
            "all_daily": self._all_daily,
            "all_barcodes": self._all_barcodes,
            "cards": self._cards,
            "purchase_totals": self._purchase_totals,
            "weekly": self.weekly_plan,
        }

    @cached_property
    def pinned_in_stock(self) -> bool:
        """One flag, found once. The product's few barcodes are staged, so the newest records, or
        without them the stock history, are scanned against a table of known, small size."""
        own = sources.option_barcodes(self.inputs.option_inventory, self.shop.pinned_product)
        own = self.staging.table(own, "pinned_barcodes")
        kept = self.inputs.newest_stock
        records = self.inputs.stock.all() if kept is None else kept
        return stock.any_in_stock(records, own).first()[0]

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines of the kept categories."""
        return sales.keep_categories(self.inputs.sales, self.shop.excluded_categories)

    @cached_property
    def options(self) -> DataFrame:
        """Option-day rollup of all products.

        A sold-out pinned product is left out here, and thereby of every list.
        """
        kept = self.inputs.option_days
        found = self.lines if kept is None else sales.keep_categories(kept, self.shop.excluded_categories)
        if not self.pinned_in_stock:
            found = found.filter(F.col("product_id") != self.shop.pinned_product)
        return self.staging.table(sales.option_days(found) if kept is None else found, "option_days")

    @cached_property
    def _blocked(self) -> DataFrame:
        shop = self.shop
        losers = sales.substitute_losers(
            self.options, shop.substitutes, self.run_date, shop.substitute_days
        )
        inactive = sales.inactive_products(self.inputs.products, shop.excluded_statuses)
        return self.staging.table(losers.union(inactive).distinct(), "blocked")

    def _flagged(self, df: DataFrame) -> DataFrame:
        """With `sellable`: whether lists may use the product."""
        return sales.flag_sellable(df, self._blocked, self.shop.excluded_products)

    @cached_property
    def _last_days(self) -> tuple[date, date]:
        row = self._get("all_daily").agg(
            F.max("day"), F.max(F.when(F.col("sellable"), F.col("day")))
        ).first()
        return row[0], row[1]

    @property
    def as_of(self) -> date:
        """The last day on which anything that lists may use was sold, or the given day."""
        return self.today or self._last_days[1]

    def need(self, *names: str) -> None:
        missing = [name for name in names if name not in self._staged]
        self._staged.update(self.staging.tables({n: self._plans[n]() for n in missing}))

    def _get(self, name: str) -> DataFrame:
        self.need(name)
        return self._staged[name]

    @property
    def daily(self) -> DataFrame:
        """Daily sales of the products that lists may use."""
        return self._get("all_daily").filter("sellable").drop("sellable")

    @property
    def barcodes(self) -> DataFrame:
        """Products and options of each barcode, with `sellable`."""
        return self._get("all_barcodes")

    @property
    def cards(self) -> DataFrame:
        """One row per product with all that is shown beside its metrics.

        Name and categories (null unless `sellable`), brand, best options with their stock,
        prices and exposure.
        """
        return self._get("cards")

    def purchase_totals(self, period: int) -> DataFrame:
        """Purchase totals that cover `period`; the usual periods share one frame."""
        if period in self.periods:
            return self._get("purchase_totals")
        name = f"purchase_totals_{period}"
        self._plans.setdefault(name, partial(self._purchase_totals, (period,)))
        return self._get(name)

    @property
    def weekly(self) -> DataFrame:
        """Weekly growth with the usual windows and thresholds."""
        return self._get("weekly")

    def _all_daily(self) -> DataFrame:
        return self._flagged(sales.daily_sales(self.options))

    def _all_barcodes(self) -> DataFrame:
        return self._flagged(sales.barcode_map(self.options))

    def _cards(self) -> DataFrame:
        inputs, shop = self.inputs, self.shop
        sellable = self._flagged(self.options).filter("sellable")
        attributes = sales.last_known(
            sellable, ["product_name", "category_m", "category_s"], self.as_of
        ).withColumn("sellable", F.lit(True))
        turnover = stock.stock_turnover(
            inputs.stock.newest(),
            self.options,
            self._last_days[0],
            alias=shop.product_alias,
            barcodes=self.barcodes.drop("sellable"),
        )
        matrix = prices.price_matrix(
            inputs.own_prices, inputs.competitor_prices, inputs.crawls, shop.competitors
        )
        exposures = inputs.exposures
        if isinstance(exposures, DataFrame):
            exposures = sources.DayHistory(exposures)
        shown = self.staging.table(exposure.popular_zones(exposures.newest()), "shown")
        streaks = exposure.streaks_by_steps(
            exposures.between, shown, partial(self.staging.table, name="streaks")
        )
        uplift = exposure.exposure_uplift(streaks, self._get("all_daily").drop("sellable"))
        return side_by_side([attributes, inputs.brands, turnover, matrix, uplift])

    def _purchase_totals(self, periods: tuple[int, ...] | None = None) -> DataFrame:
        periods = periods or self.periods
        counts = repurchase.purchase_counts(self.lines, self.as_of, periods)
        return repurchase.purchase_totals(counts, periods)

    def weekly_plan(
        self, *, latest_days: int = 7, compare_days: int = 28, **thresholds: float
    ) -> DataFrame:
        low = self.as_of - timedelta(days=latest_days + compare_days)
        in_stock = growth.stock_days(
            self.inputs.stock.since(low), self.barcodes, low, self.as_of
        )
        return growth.weekly_growth(
            self.daily,
            in_stock,
            self.as_of,
            latest_days=latest_days,
            compare_days=compare_days,
            **thresholds,
        )


def side_by_side(parts: Sequence[DataFrame]) -> DataFrame:
    """Frames with at most one row per product, as one row per product that any of them has.

    Stacked under one aggregate, each part is shuffled once, however many there are; a chain
    of full joins would shuffle the growing left side again for every one.
    """
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    columns = [c for c in stacked.columns if c != "product_id"]
    return stacked.groupBy("product_id").agg(*[F.max(c).alias(c) for c in columns])
