from shelfpulse.plans.lists import (
    growth_list,
    ranking_list,
    repurchase_list,
)
from shelfpulse.plans.newest import KeptNewest, kept_crawls, kept_stock
from shelfpulse.plans.placement import exclusive_lists, placement_list
from shelfpulse.plans.publish import Published, publish_growth, publish_ranking, publish_repurchase, run
from shelfpulse.plans.rollup import KeptRollup
from shelfpulse.plans.signals import Inputs, Signals

__all__ = [
    "Inputs",
    "KeptNewest",
    "KeptRollup",
    "Published",
    "Signals",
    "exclusive_lists",
    "growth_list",
    "kept_crawls",
    "kept_stock",
    "placement_list",
    "publish_growth",
    "publish_ranking",
    "publish_repurchase",
    "ranking_list",
    "repurchase_list",
    "run",
]
