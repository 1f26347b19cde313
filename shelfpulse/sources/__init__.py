from shelfpulse.sources.history import DatedHistory, DayHistory, EpochHistory, History
from shelfpulse.sources.market import (
    competitor_prices,
    crawl_status,
    newest_crawls,
    own_prices,
    with_prices,
)
from shelfpulse.sources.shop import (
    brands,
    cart_rows,
    exposure_history,
    history_start,
    option_barcodes,
    product_statuses,
    reviews,
    sales_lines,
    search_history,
    stock_history,
    user_rows,
)
from shelfpulse.sources.tables import Tables

__all__ = [
    "DatedHistory",
    "DayHistory",
    "EpochHistory",
    "History",
    "Tables",
    "brands",
    "cart_rows",
    "competitor_prices",
    "crawl_status",
    "exposure_history",
    "history_start",
    "newest_crawls",
    "option_barcodes",
    "own_prices",
    "product_statuses",
    "reviews",
    "sales_lines",
    "search_history",
    "stock_history",
    "user_rows",
    "with_prices",
]
