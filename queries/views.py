"""The shop's inputs as views of the test tables, in SQL that Spark and DuckDB both run.

``VIEWS`` maps a view name to its text; views may use earlier ones.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.config import ShopConfig

RUN_DATE = date(2001, 8, 1)
CART_START, CART_END = date(2024, 1, 5), date(2024, 1, 20)
TABLES = ("customer", "orders", "lineitem", "events")

SHOP = ShopConfig(
    pinned_product=31,
    substitutes=(20, 21),
    product_alias=((24, 26),),
    excluded_products=(33,),
    excluded_brands=("Jan Tana",),
    excluded_categories=("excluded",),
)

_COMPETITOR = (
    "CASE l_suppkey % 4 WHEN 0 THEN '11st' WHEN 1 THEN 'Coupang' WHEN 2 THEN 'Iherb' ELSE 'Ople' END"
)

VIEWS = {
    # Some products sell only since a day, or rarely: their other lines are ten years older.
    "fx_sales": """
SELECT order_id, user_id, product_id, product_name, barcode, variant_name, category_m, category_s,
 CASE WHEN (product_id % 10 = 7 AND ordered_at < DATE '2000-11-01')
   OR (product_id % 10 = 3 AND ordered_at < DATE '2001-04-20')
   OR (product_id % 10 = 9 AND line_no <> 1) THEN CAST(ordered_at - INTERVAL 10 YEAR AS DATE)
  ELSE ordered_at END AS purchased_at, product_qty, line_no, product_price, marked_down_price
FROM (
 SELECT CAST(l_orderkey*10 + l_linenumber AS BIGINT) AS order_id, CAST(o_custkey % 40 AS BIGINT) AS user_id,
  CAST(l_partkey % 60 AS BIGINT) AS product_id, CONCAT('product ', CAST(l_partkey % 60 AS VARCHAR(10))) AS product_name,
  CAST((l_partkey % 60)*10 + CASE WHEN (l_partkey % 60) % 5 = 0 THEN 0 ELSE l_suppkey % 3 END AS VARCHAR(10)) AS barcode,
  CONCAT('option ', CAST(CASE WHEN (l_partkey % 60) % 5 = 0 THEN 0 ELSE l_suppkey % 3 END AS VARCHAR(10))) AS variant_name,
  CASE WHEN (l_partkey % 60) = 59 THEN 'excluded' WHEN (l_partkey % 60) = 58 THEN NULL
       ELSE CONCAT('cat', CAST((l_partkey % 60) % 6 AS VARCHAR(10))) END AS category_m,
  CONCAT('sub', CAST((l_partkey % 60) % 9 AS VARCHAR(10))) AS category_s,
  CAST(o_orderdate AS DATE) AS ordered_at, l_quantity AS product_qty, l_linenumber AS line_no,
  l_extendedprice AS product_price, l_extendedprice * (1 - l_discount) AS marked_down_price
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey) s""",
    # Every line is a delivery on one of 43 days; some products' stock has barcodes never sold.
    "fx_stock": """
SELECT barcode, day, CAST(CASE WHEN SUM(line) % 11 < 2 THEN 0 ELSE SUM(l_quantity) END AS BIGINT) AS amount
FROM (
 SELECT CAST((l_partkey % 60)*10 + CASE WHEN l_partkey % 60 % 12 = 11 THEN 9000 ELSE 0 END
   + CASE WHEN (l_partkey % 60) % 5 = 0 THEN 0 ELSE l_suppkey % 3 END AS VARCHAR(10)) AS barcode,
  DATE '2001-06-20' + CAST((l_orderkey*7 + l_linenumber*3) % 43 AS INT) AS day,
  l_orderkey + l_linenumber AS line, l_quantity FROM lineitem) d
GROUP BY barcode, day""",
    "fx_brand": """
SELECT DISTINCT product_id, CASE WHEN product_id = 4 THEN 'Jan Tana' WHEN product_id = 6 THEN NULL
  ELSE CONCAT('Brand#', CAST(product_id % 7 AS VARCHAR(10))) END AS brand FROM fx_sales""",
    "fx_status": """
SELECT DISTINCT product_id, CASE WHEN product_id = 8 THEN 'D' WHEN product_id = 12 THEN 'H' ELSE 'A' END AS status
FROM fx_sales WHERE product_id <> 14""",
    "fx_ev": None,
    "fx_exposure": """
SELECT product_id, day, value AS popularity, CONCAT('zone', CAST(event_id % 3 AS VARCHAR(10))) AS main_rec_category
FROM fx_ev WHERE event_type = 'view'""",
    "fx_search": "SELECT event_id AS idx, product_id, day FROM fx_ev WHERE event_type = 'click'",
    "fx_review": """
SELECT event_id AS post_id, product_id, CAST(FLOOR(value) AS BIGINT) % 5 + 1 AS rating_value,
  CONCAT('msg ', CAST(event_id AS VARCHAR(20))) AS message, day AS post_day FROM fx_ev WHERE event_type = 'purchase'""",
    "fx_cmpt": f"""
SELECT DISTINCT {_COMPETITOR} AS competitor,
  CAST(l_partkey % 60 AS BIGINT) AS product_id,
  DATE '2001-06-12' + CAST((l_orderkey*7 + l_linenumber) % 20 AS INT) AS date,
  CAST(CASE WHEN l_partkey % 13 = 0 THEN -1.0 ELSE 100.0 + l_partkey % 60 END AS DOUBLE) AS krw_price,
  CAST(CASE WHEN l_partkey % 17 = 0 THEN 0.0 ELSE 1.0 END AS DOUBLE) AS usd_price
FROM lineitem""",
    # Prices by ship day, of which the newest has few.
    "fx_cmpt_history": f"""
SELECT DISTINCT {_COMPETITOR} AS competitor,
  CAST(l_partkey % 60 AS BIGINT) AS product_id, CAST(l_shipdate AS DATE) AS date,
  CAST(CASE WHEN l_partkey % 13 = 0 THEN -1.0 ELSE 100.0 + l_partkey % 60 END AS DOUBLE) AS krw_price,
  CAST(CASE WHEN l_partkey % 17 = 0 THEN 0.0 ELSE 1.0 END AS DOUBLE) AS usd_price
FROM lineitem""",
    "fx_crawl": f"""
SELECT DISTINCT {_COMPETITOR} AS competitor,
  CAST(l_partkey % 60 AS BIGINT) AS product_id, CAST(l_shipdate AS DATE) AS update_date,
  CAST(CASE WHEN (l_partkey + l_suppkey) % 9 = 0 THEN 0 ELSE 1 END AS BIGINT) AS sale_or_not
FROM lineitem""",
    "fx_item": "SELECT DISTINCT CAST(product_id * 3 AS BIGINT) AS id, product_id FROM fx_sales",
    "fx_item_price": """
SELECT CAST((l_partkey % 60) * 3 AS BIGINT) AS item_id, CAST(l_shipdate AS DATE) AS date,
  CAST(100 + l_partkey % 60 AS DOUBLE) AS krw_price
FROM lineitem WHERE l_partkey % 60 < 50
UNION ALL
SELECT CAST((l_partkey % 60) * 3 AS BIGINT) AS item_id, DATE '2001-12-31' AS date,
  CAST(100 + l_partkey % 60 AS DOUBLE) AS krw_price
FROM lineitem WHERE l_partkey % 60 < 50""",
    "fx_own": "SELECT DISTINCT product_id, CAST(100 + product_id AS DOUBLE) AS price_own FROM fx_sales WHERE product_id < 50",
    "fx_cart": None,
    "fx_users": """
SELECT c_custkey AS user_id, CASE WHEN c_custkey % 10 = 0 THEN 'D' ELSE 'A' END AS status, 'C' AS user_type,
  CAST(c_nationkey AS BIGINT) AS company_id, CAST(1600000000 + c_custkey * 4321 AS BIGINT) AS last_login,
  CAST(1500000000 + c_custkey * 12345 AS BIGINT) AS timestamp, c_name AS firstname, c_mktsegment AS lastname,
  CAST(NULL AS VARCHAR(10)) AS birthday, CAST(NULL AS VARCHAR(10)) AS age_range, CAST(NULL AS VARCHAR(10)) AS gender
FROM customer""",
    "fx_posts": None,
    "fx_ratings": """
SELECT product_id + 1000 AS thread_id, post_id, rating_value FROM fx_review WHERE post_id % 50 <> 3""",
    "fx_messages": """
SELECT product_id + 1000 AS thread_id, post_id,
  CASE WHEN post_id % 7 = 0 THEN NULL
       WHEN post_id % 3 = 0 THEN REPLACE(message, ' ', CONCAT(CHR(13), CHR(10)))
       WHEN post_id % 3 = 1 THEN REPLACE(message, ' ', CHR(13)) ELSE CONCAT(message, CHR(10), 'end') END AS message
FROM fx_review""",
    "fx_threads": """
SELECT DISTINCT product_id + 1000 AS thread_id, product_id AS object_id,
  CASE WHEN product_id % 11 = 10 THEN 'C' ELSE 'P' END AS object_type FROM fx_sales""",
    "fx_names": """
SELECT DISTINCT product_id, 'ko' AS lang_code, product_name AS product FROM fx_sales
UNION ALL SELECT DISTINCT product_id, 'en' AS lang_code, CONCAT('item ', product_name) AS product FROM fx_sales""",
    "fx_feature": """
SELECT DISTINCT product_id, product_id % 7 + 100 AS variant_id, 'ko' AS lang_code, CAST(19 AS BIGINT) AS feature_id FROM fx_sales
UNION ALL SELECT DISTINCT product_id, product_id % 7 + 200 AS variant_id, 'ko' AS lang_code, CAST(19 AS BIGINT) AS feature_id
 FROM fx_sales WHERE product_id % 4 = 0
UNION ALL SELECT DISTINCT product_id, product_id % 7 + 300 AS variant_id, 'en' AS lang_code, CAST(19 AS BIGINT) AS feature_id FROM fx_sales
UNION ALL SELECT DISTINCT product_id, CAST(50 AS BIGINT) AS variant_id, 'ko' AS lang_code, CAST(18 AS BIGINT) AS feature_id FROM fx_sales""",
    "fx_variant": """
SELECT DISTINCT product_id % 7 + 100 AS variant_id, 'ko' AS lang_code,
  CONCAT(CHR(9), 'Brand', CHR(9), CAST(product_id % 7 AS VARCHAR(10))) AS variant FROM fx_sales WHERE product_id % 7 <> 6
UNION ALL SELECT DISTINCT product_id % 7 + 100 AS variant_id, 'en' AS lang_code, 'other' AS variant FROM fx_sales""",
}

_SPARK = {
    "fx_ev": """
SELECT event_id, event_type, value, CAST(get_json_object(props,'$.k') AS BIGINT) % 60 AS product_id,
  date_sub(CAST(ts AS DATE), 8217) AS day FROM events""",
    "fx_cart": """
SELECT user_id, 'C' AS type, 'R' AS user_type, event_id AS item_id, 'P' AS item_type,
  CAST(get_json_object(props,'$.k') AS BIGINT) % 60 AS product_id, CAST(1 AS BIGINT) AS amount, value AS price,
  unix_seconds(CAST(ts AS TIMESTAMP)) AS timestamp FROM events WHERE event_type = 'signup'""",
    "fx_posts": """
SELECT post_id, product_id + 1000 AS thread_id, post_id % 40 AS user_id, 'A' AS status,
  unix_seconds(CAST(post_day AS TIMESTAMP)) + (post_id % 24) * 3600 AS timestamp FROM fx_review""",
}
_DUCKDB = {
    "fx_ev": """
SELECT event_id, event_type, value, CAST(json_extract_string(props,'$.k') AS BIGINT) % 60 AS product_id,
  CAST(CAST(ts AS DATE) - INTERVAL 8217 DAY AS DATE) AS day FROM events""",
    "fx_cart": """
SELECT user_id, 'C' AS type, 'R' AS user_type, event_id AS item_id, 'P' AS item_type,
  CAST(json_extract_string(props,'$.k') AS BIGINT) % 60 AS product_id, CAST(1 AS BIGINT) AS amount, value AS price,
  CAST(FLOOR(epoch(ts)) AS BIGINT) AS timestamp FROM events WHERE event_type = 'signup'""",
    "fx_posts": """
SELECT post_id, product_id + 1000 AS thread_id, post_id % 40 AS user_id, 'A' AS status,
  CAST(epoch(CAST(post_day AS TIMESTAMP)) AS BIGINT) + (post_id % 24) * 3600 AS timestamp FROM fx_review""",
}


def view_text(name: str, engine: str) -> str:
    return VIEWS[name] or {"spark": _SPARK, "duckdb": _DUCKDB}[engine][name]


class Fixtures:
    """The views over one folder of test tables, as DataFrames, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in VIEWS:
                text = view_text(name, "spark")
                for used in needed(text):
                    self[used].createOrReplaceTempView(used)
                self._frames[name] = self.spark.sql(text)
            else:
                self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]

    def __setitem__(self, name: str, frame: DataFrame) -> None:
        self._frames[name] = frame


def raw_sales(fx: Fixtures) -> DataFrame:
    """The order lines as a shop's raw table."""
    moment = F.col("purchased_at").cast("timestamp").alias("purchased_at")
    sales = fx["fx_sales"].drop("line_no")
    return sales.select(*[c for c in sales.columns if c != "purchased_at"], moment)


def raw_frames(fx: Fixtures) -> dict[str, DataFrame]:
    """The views as a shop's raw tables, with epochs where a shop keeps them."""
    epoch = F.unix_seconds(F.col("day").cast("timestamp")) - 14 * 3600 + 60
    sales = fx["fx_sales"]
    return {
        "sales": raw_sales(fx),
        "stock": fx["fx_stock"].select("barcode", "amount", epoch.alias("timestamp")),
        "products": fx["fx_status"],
        "feature_values": fx["fx_feature"],
        "variant_names": fx["fx_variant"],
        "exposures": fx["fx_exposure"].select(
            "product_id", F.col("day").cast("timestamp").alias("date"), "popularity", "main_rec_category"
        ),
        "searches": fx["fx_search"].select("idx", "product_id", epoch.alias("timestamp")),
        "option_inventory": sales.select("product_id", "barcode").distinct(),
        "posts": fx["fx_posts"],
        "ratings": fx["fx_ratings"],
        "messages": fx["fx_messages"],
        "threads": fx["fx_threads"],
        "product_names": fx["fx_names"],
        "competitor_prices": fx["fx_cmpt"],
        "crawls": fx["fx_crawl"].withColumn("update_date", F.col("update_date").cast("timestamp")),
        "items": fx["fx_item"],
        "item_prices": fx["fx_item_price"],
    }


def needed(text: str) -> list[str]:
    """Views and tables that a text names, in order of first mention."""
    words = re.findall(r"[a-z_]+", text)
    return [w for w in dict.fromkeys(words) if w in VIEWS or w in TABLES]
