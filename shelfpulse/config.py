"""Settings of one shop: ids, names and constants that are data, not logic."""

from __future__ import annotations

from dataclasses import dataclass

# Status words of a competitor price, as published.
PRICE_OK = "정상수집"
PRICE_NOT_SOLD = "미판매"
PRICE_CRAWL_ERROR = "수집오류"
PRICE_NOT_COLLECTED = "미수집"

# Zone labels of the placement list.
RANKING_ZONE = "주간 랭킹"
REPURCHASE_ZONE = "재구매율 높은"
GROWTH_ZONE = "판매 급상승"


@dataclass(frozen=True, kw_only=True)
class ShopConfig:
    """Defaults are the published job's constants, but for the categories to leave out: their
    names belong to the shop that runs the job and have to be given, if only as empty.

    ``bypass_products`` are spared the turnover and exposure conditions, as the pinned product
    always is.
    """

    excluded_categories: tuple[str, ...]
    bypass_products: tuple[int, ...] = ()
    pinned_product: int = 314
    substitutes: tuple[int, ...] = (4109, 2674)
    substitute_days: int = 90
    product_alias: tuple[tuple[int, int], ...] = ((4241, 2980),)
    excluded_products: tuple[int, ...] = (5376,)
    excluded_brands: tuple[str, ...] = ("Jan Tana",)
    excluded_statuses: tuple[str, ...] = ("D", "H")
    brand_feature: int = 19
    language: str = "ko"
    clock_shift_hours: int = 14
    history_months: int = 24
    competitors: tuple[str, ...] = ("11st", "Coupang", "Iherb", "Ople")
    list_size: int = 50
    placed_per_list: int = 15

    @property
    def exempt_products(self) -> list[int]:
        return [self.pinned_product, *self.bypass_products]
