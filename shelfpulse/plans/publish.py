"""The four published tables: column names, order and the weekly run that writes them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.config import ShopConfig
from shelfpulse.functions import np_round
from shelfpulse.operators.prices import display_price, price_columns
from shelfpulse.plans.placement import ListRun, exclusive_lists, placement_list
from shelfpulse.plans.signals import Inputs, Signals
from shelfpulse.session import Staging
from shelfpulse.sources.ledger import Ledger

# Published column names, in order, each with the engine's column. The prices of
# the shop's competitors follow the own price.
RANKING_COLUMNS = {
    "BRAND": "brand",
    "PRODUCT_NAME_KOR": "product_name",
    "SCORE_TOTAL": "score",
    "SCORE_AVG_QTY": "last_avg_qty_grade",
    "SCORE_GRWRATE_WEEK": "growth_rate_grade",
    "SCORE_GRWRATE_QUT": "qoq_rate_grade",
    "SCORE_GRWRATE_YEAR": "yoy_rate_grade",
    "SCORE_REPCHS": "repurchase_index_grade",
    "SCORE_SEARCH": "search_count_grade",
    "SCORE_NEG_RVW": "negative_reviews",
    "PRICE_MZ": "price_own",
    "LAST_AVG_QTY": "last_avg_qty",
    "PAST_AVG_QTY": "past_avg_qty",
    "GRWRATE_WEEK": "growth_rate",
    "GRWRATE_QUT": "qoq_rate",
    "GRWRATE_YEAR": "yoy_rate",
    "REPCHS_INDEX": "repurchase_index",
    "REPCHS_CNT": "repurchase_count",
    "PCHS_CNT": "purchase_count",
    "REPCHS_CNT_RATE": "repurchase_rate",
    "REPCHS_USER": "repurchase_users",
    "REPCHS_USER_RATE": "repurchase_user_rate",
    "AVG_RATING": "avg_rating",
    "RVW_CNT": "review_count",
    "RVW_LENGTH": "review_length",
    "NEG_RVW_CASE": "negative_case",
    "OOS_DAYS": "oos_days",
    "OOS_RATE": "oos_rate",
    "SEARCH_NUM": "search_count",
    "PRODUCT_ID": "product_id",
    "CATEGORY_M": "category_m",
    "CATEGORY_S": "category_s",
    "OPTION_BARCODE_1ST": "opt1_barcode",
    "OPTION_NAME_1ST": "opt1_name",
    "OPTION_SALE_RATE_1ST": "opt1_share",
    "OPTION_STCK_1ST": "opt1_stock",
    "OPTION_DSI_1ST": "opt1_dsi",
    "OPTION_BARCODE_2ND": "opt2_barcode",
    "OPTION_NAME_2ND": "opt2_name",
    "OPTION_SALE_RATE_2ND": "opt2_share",
    "OPTION_STCK_2ND": "opt2_stock",
    "OPTION_DSI_2ND": "opt2_dsi",
    "MAIN_REC_LAST_CATEGORY": "main_rec_category",
    "MAIN_REC_START_DATE": "exposure_start",
    "MAIN_REC_GRWRATE": "exposure_uplift",
    "DATE": "date",
    "RANK_NUM": "rank",
}
REPURCHASE_COLUMNS = {
    "BRAND": "brand",
    "PRODUCT_NAME_KOR": "product_name",
    "SCORE_TOTAL": "score",
    "SCORE_REPCHS_CNT_RATE": "repurchase_rate_grade",
    "SCORE_REPCHS_USER_RATE": "repurchase_user_rate_grade",
    "SCORE_AVG_QTY": "last_avg_qty_grade",
    "REPCHS_INDEX": "repurchase_index",
    "PRICE_MZ": "price_own",
    "REPCHS_CNT_RATE": "repurchase_rate",
    "REPCHS_USER_RATE": "repurchase_user_rate",
    "REPCHS_CNT": "repurchase_count",
    "PCHS_CNT": "purchase_count",
    "REPCHS_USER": "repurchase_users",
    "LAST_AVG_QTY": "last_avg_qty",
    "OPTION_STCK_1ST": "opt1_stock",
    "OPTION_DSI_1ST": "opt1_dsi",
    "OPTION_SALE_RATE_1ST": "opt1_share",
    "OPTION_STCK_2ND": "opt2_stock",
    "OPTION_DSI_2ND": "opt2_dsi",
    "OPTION_SALE_RATE_2ND": "opt2_share",
    "PRODUCT_ID": "product_id",
    "OPTION_BARCODE_1ST": "opt1_barcode",
    "OPTION_BARCODE_2ND": "opt2_barcode",
    "CATEGORY_M": "category_m",
    "CATEGORY_S": "category_s",
    "OPTION_NAME_1ST": "opt1_name",
    "OPTION_NAME_2ND": "opt2_name",
    "MAIN_REC_LAST_CATEGORY": "main_rec_category",
    "MAIN_REC_START_DATE": "exposure_start",
    "MAIN_REC_GRWRATE": "exposure_uplift",
    "DATE": "date",
    "RANK_NUM": "rank",
}
GROWTH_COLUMNS = {
    "BRAND": "brand",
    "PRODUCT_NAME_KOR": "product_name",
    "GRWRATE": "growth_rate",
    "LAST_AVG_QTY": "last_avg_qty",
    "PAST_AVG_QTY": "past_avg_qty",
    "PRICE_MZ": "price_own",
    "LT_GRWRATE": "lt_growth",
    "OPTION_NAME_1ST": "opt1_name",
    "OPTION_STCK_1ST": "opt1_stock",
    "OPTION_DSI_1ST": "opt1_dsi",
    "OPTION_SALE_RATE_1ST": "opt1_share",
    "OPTION_NAME_2ND": "opt2_name",
    "OPTION_STCK_2ND": "opt2_stock",
    "OPTION_DSI_2ND": "opt2_dsi",
    "OPTION_SALE_RATE_2ND": "opt2_share",
    "PRODUCT_ID": "product_id",
    "OPTION_BARCODE_1ST": "opt1_barcode",
    "OPTION_BARCODE_2ND": "opt2_barcode",
    "MAIN_REC_LAST_CATEGORY": "main_rec_category",
    "MAIN_REC_START_DATE": "exposure_start",
    "MAIN_REC_GRWRATE": "exposure_uplift",
    "DATE": "date",
    "RANK_NUM": "rank",
}
PLACEMENT_COLUMNS = {
    "PRODUCT_ID": "product_id",
    "DATE": "date",
    "MAIN_REC_CATEGORY": "main_rec_category",
    "LOCATION": "location",
}
# Columns that the published tables round once more.
ROUNDED = {"repurchase_index": 4, "avg_rating": 4}


def with_competitors(columns: dict[str, str], competitors: Sequence[str]) -> dict[str, str]:
    """The columns, with a price column of each competitor behind the own price."""
    found = {}
    for target, source in columns.items():
        found[target] = source
        if source == "price_own":
            prices = price_columns(competitors)
            found |= {f"PRICE_{n.upper()}": c for n, c in zip(competitors, prices, strict=True)}
    return found


def published(
    df: DataFrame, columns: dict[str, str], run_date: date, competitors: Sequence[str]
) -> DataFrame:
    """Select by name, show prices as one cell, and round what is published rounded."""
    cells = []
    for target, source in with_competitors(columns, competitors).items():
        if source.startswith("price_"):
            value = display_price(source)
        elif source == "date":
            value = F.lit(run_date)
        elif source in ROUNDED:
            value = np_round(F.col(source), ROUNDED[source])
        else:
            value = F.col(source)
        cells.append(value.alias(target))
    return df.select(*cells)


def publish_ranking(ranking: DataFrame, run_date: date, shop: ShopConfig) -> DataFrame:
    return published(ranking, RANKING_COLUMNS, run_date, shop.competitors)


def publish_repurchase(repurchase: DataFrame, run_date: date, shop: ShopConfig) -> DataFrame:
    return published(repurchase, REPURCHASE_COLUMNS, run_date, shop.competitors)


def publish_growth(growth: DataFrame, run_date: date, shop: ShopConfig) -> DataFrame:
    return published(growth, GROWTH_COLUMNS, run_date, shop.competitors)


def publish_placement(placement: DataFrame) -> DataFrame:
    return placement.select(*[F.col(c).alias(n) for n, c in PLACEMENT_COLUMNS.items()])


#: Versions of a week that stay readable: the current one, and the one that readers who began
#: before it may still read.
KEPT_VERSIONS = 2
LEDGER = "_published"


class Published:
    """The published tables below one folder, each week in versions.

    A version is one folder per table, `<table>/run_date=<day>/version=<name>`. It counts from
    the moment on that its record is in the week's ledger, and with it all tables change
    together: whatever fails before, readers find the week as it was.
    """

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")

    def _ledger(self, run_date: str) -> Ledger:
        return Ledger(self.spark, f"{self.target}/{LEDGER}/run_date={run_date}")

    def _folder(self, name: str, run_date: str, version: str = "") -> str:
        return f"{self.target}/{name}/run_date={run_date}" + (f"/version={version}" if version else "")

    def write(self, tables: Mapping[str, DataFrame], run_date: date) -> None:
        """Publish one week; each table is a list of some dozens of rows, so one file."""
        day, version = run_date.isoformat(), uuid.uuid4().hex
        for name, df in tables.items():
            write_table(df, self._folder(name, day, version))
        ledger = self._ledger(day)
        ledger.add({"version": version, "tables": list(tables)})
        self._drop_old(ledger, day)

    def _drop_old(self, ledger: Ledger, day: str) -> None:
        """Delete what neither of the last versions holds, parts of failed runs too."""
        kept = [ledger.read(n) for n in ledger.numbers()[:KEPT_VERSIONS]]
        names = {f"version={record['version']}" for record in kept}
        for name in {table for record in kept for table in record["tables"]}:
            folder = self._folder(name, day)
            for old in set(ledger.folders(folder)) - names:
                ledger.delete(f"{folder}/{old}")

    def days(self) -> list[str]:
        """The published weeks."""
        root = Ledger(self.spark, f"{self.target}/{LEDGER}")
        return [n.removeprefix("run_date=") for n in root.folders(root.path)]

    def read(self, name: str, run_date: date | None = None) -> DataFrame:
        """A published table with its column `run_date`, of one week or of all."""
        days = [run_date.isoformat()] if run_date else self.days()
        records = {day: self._ledger(day).newest() for day in days}
        paths = [
            self._folder(name, day, record["version"])
            for day, record in records.items()
            if record and name in record["tables"]
        ]
        if not paths:
            raise ValueError(f"{name} is not published" + (f" for {run_date}" if run_date else ""))
        found = self.spark.read.option("basePath", f"{self.target}/{name}").parquet(*paths)
        return found.drop("version").withColumn("run_date", F.to_date("run_date"))


def write_table(df: DataFrame, folder: str) -> None:
    df.coalesce(1).write.mode("errorifexists").parquet(folder)


def published_tables(signals: Signals, lists: ListRun) -> dict[str, DataFrame]:
    day, shop = signals.run_date, signals.shop
    return {
        "placement": publish_placement(placement_list(signals, lists)),
        "ranking": publish_ranking(lists.ranking, day, shop),
        "repurchase": publish_repurchase(lists.repurchase, day, shop),
        "growth": publish_growth(lists.growth, day, shop),
    }


def run(
    spark: SparkSession,
    inputs: Inputs,
    run_date: date,
    target: str,
    shop: ShopConfig,
) -> None:
    """The weekly job: build the lists of `run_date` and write the four tables below `target`.

    All four are built before the first is written, and take effect together (see `Published`):
    a failure at any point leaves the week as it was.
    """
    staging = Staging(spark)
    try:
        signals = Signals(spark, inputs, shop, run_date, staging=staging)
        tables = staging.tables(published_tables(signals, exclusive_lists(signals)))
        Published(spark, target).write(tables, run_date)
    finally:
        staging.drop()
