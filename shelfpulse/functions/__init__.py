from shelfpulse.functions.columns import (
    day_from_epoch,
    epoch_of,
    month_index,
    not_in_keep_null,
    np_round,
    one_line,
    pdiv,
    steady_mean,
    strip_tabs,
    timestamp_from_epoch,
    within,
)

__all__ = [
    "day_from_epoch",
    "epoch_of",
    "month_index",
    "not_in_keep_null",
    "np_round",
    "one_line",
    "pdiv",
    "steady_mean",
    "strip_tabs",
    "timestamp_from_epoch",
    "within",
]
