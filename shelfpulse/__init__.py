"""Weekly merchandising analytics for an online shop, written for Spark."""

from shelfpulse.config import ShopConfig

__all__ = ["ShopConfig"]
