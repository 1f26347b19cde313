"""Long-term trend: slope of a robust line through a product's monthly sales."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from shelfpulse.functions import month_index, np_round

# The robust fit's threshold and ridge penalty.
EPSILON = 1.35
ALPHA = 1e-4
# A fit is done when a round moves the slope by no more than this, and the scale by no more than
# this share of it. Slopes are shares of the best month per month, published with two digits.
TOLERANCE = 1e-8
# Rounds of reweighting, after which a series is fitted by halving, which always ends.
ROUNDS = 500
# Halvings of an interval: a double has no more digits.
HALVINGS = 60
# Smallest scale, that of points on a line.
TINY = np.finfo(float).eps * 10


def monthly_sales(daily: DataFrame) -> DataFrame:
    """Quantity per product and calendar month, months counted from the very first one."""
    first = daily.agg(F.trunc(F.min("day"), "month")).scalar()
    return (
        daily.groupBy("product_id", F.trunc("day", "month").alias("month"))
        .agg(F.sum("qty").alias("qty"))
        .select("product_id", month_index(F.col("month"), first).alias("month_num"), "qty")
    )


def robust_slopes(
    x: np.ndarray, y: np.ndarray, known: np.ndarray, rounds: int = ROUNDS
) -> np.ndarray:
    """Slopes of many small series at once; each row is one series, padded where not `known`.

    Line, intercept and scale minimise together sum(s + s*H((x*w + c - y) / s)) + ALPHA*w^2
    with H(z) = z^2 up to EPSILON and linear beyond. Weighted least squares for the line and
    a closed form for the scale take turns until neither moves; a series that is done leaves
    the batch. Those that still move after `rounds`, such as points of which just as many lie on
    a line as the scale needs to vanish, are fitted by `halved_slopes`.
    """
    found = np.full(len(x), np.nan)
    rows = np.arange(len(x))
    slope, level = np.zeros(len(x)), np.zeros(len(x))
    scale = np.ones(len(x))
    for _ in range(rounds):
        if not len(rows):
            break
        count = known.sum(axis=1)
        before, width = slope, scale
        error = np.abs(x * slope[:, None] + level[:, None] - y)
        limit = EPSILON * scale[:, None]
        weight = np.where(error <= limit, 1.0, limit / np.where(error > 0, error, 1.0)) * known
        total = weight.sum(axis=1)
        x_mean = (weight * x).sum(axis=1) / total
        y_mean = (weight * y).sum(axis=1) / total
        x_off = x - x_mean[:, None]
        slope = (weight * x_off * (y - y_mean[:, None])).sum(axis=1) / (
            (weight * x_off**2).sum(axis=1) + ALPHA * scale
        )
        level = y_mean - slope * x_mean
        error = np.abs(x * slope[:, None] + level[:, None] - y)
        inside = (error <= limit) & known
        spread = count - EPSILON**2 * (known & ~inside).sum(axis=1)
        squares = (np.where(inside, error, 0.0) ** 2).sum(axis=1)
        fitted = np.sqrt(squares / np.where(spread > 0, spread, 1.0))
        scale = np.maximum(np.where(spread > 0, fitted, scale * 0.9), TINY)
        still = np.abs(slope - before) <= TOLERANCE
        done = still & (np.abs(scale - width) <= TOLERANCE * (width + TOLERANCE))
        if done.any():
            found[rows[done]] = slope[done]
            x, y, known, rows, slope, level, scale = (
                a[~done] for a in (x, y, known, rows, slope, level, scale)
            )
    if len(rows):
        found[rows] = halved_slopes(x, y, known)
    return found


def halved_slopes(x: np.ndarray, y: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The same slopes by halving, in a fixed number of steps.

    The objective is convex in line and scale together, so its minimum over the other two is
    convex in the slope, with the derivative that it has at that minimum. Its sign tells on which
    side of a slope the best one lies; the level of a given slope is found alike, and the scale of
    a given line is exact (`best_scale`). The best slope is not steeper than the steepest line
    through two points.
    """
    gaps = np.abs(x[:, :, None] - x[:, None, :])
    rises = np.abs(y[:, :, None] - y[:, None, :])
    pairs = known[:, :, None] & known[:, None, :] & (gaps > 0)
    steepest = np.where(pairs, rises / np.where(pairs, gaps, 1.0), 0.0).max(axis=(1, 2))
    low, high = -steepest, steepest.copy()
    for _ in range(HALVINGS):
        slope = (low + high) / 2
        pull = _pull(y - x * slope[:, None], known)
        rising = (pull * x).sum(axis=1) < ALPHA * slope
        low, high = np.where(rising, low, slope), np.where(rising, slope, high)
    return (low + high) / 2


def _pull(error: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Half the derivative of the objective by each point's error at the best level and scale,
    each between -EPSILON and EPSILON. At the best level they add up to zero; the two sides of it
    that the last halving leaves are mixed so that they do."""
    low = np.where(known, error, np.inf).min(axis=1)
    high = np.where(known, error, -np.inf).max(axis=1)
    for _ in range(HALVINGS):
        level = (low + high) / 2
        above = _bent(error - level[:, None], known).sum(axis=1) > 0
        low, high = np.where(above, level, low), np.where(above, high, level)
    under, over = (_bent(error - edge[:, None], known) for edge in (low, high))
    more, less = under.sum(axis=1), over.sum(axis=1)
    share = np.where(more > less, more / np.where(more > less, more - less, 1.0), 0.5)
    share = np.clip(share, 0.0, 1.0)[:, None]
    return under * (1 - share) + over * share


def _bent(error: np.ndarray, known: np.ndarray) -> np.ndarray:
    scale = best_scale(np.abs(error), known)
    return np.clip(error / scale[:, None], -EPSILON, EPSILON) * known


def best_scale(size: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The scale at which the squared sizes, each cut off at EPSILON scales, add up to as many
    squared scales as there are points. With the k smallest inside, it is the root of their
    squares over what the others leave of the count; the right k is the one whose scale has just
    these inside. No scale is small enough where too few sizes are above zero."""
    ordered = np.sort(np.where(known, size, np.inf), axis=1)
    count = known.sum(axis=1)[:, None]
    inside = np.arange(1, size.shape[1] + 1)[None, :]
    finite = np.where(np.isfinite(ordered), ordered, 0.0)
    left = count - EPSILON**2 * (count - inside)
    valid = (left > 0) & (inside <= count)
    scale = np.sqrt(np.cumsum(finite**2, axis=1) / np.where(valid, left, 1.0))
    after = np.concatenate([ordered[:, 1:], np.full((len(ordered), 1), np.inf)], axis=1)
    fits = valid & (after >= EPSILON * scale)
    first = np.argmax(fits, axis=1)
    found = np.take_along_axis(scale, first[:, None], axis=1)[:, 0]
    return np.maximum(np.where(fits.any(axis=1), found, TINY), TINY)


@pandas_udf(DoubleType())
def _slope(months: pd.Series, shares: pd.Series) -> pd.Series:
    sizes = np.array([len(m) for m in months], dtype=int)
    if len(sizes) == 0:
        return pd.Series([], dtype=float)
    known = np.arange(sizes.max())[None, :] < sizes[:, None]
    x, y = np.zeros(known.shape), np.zeros(known.shape)
    x[known] = np.concatenate(months.to_numpy())
    y[known] = np.concatenate(shares.to_numpy())
    return pd.Series(robust_slopes(x, y, known))


def long_term_growth(daily: DataFrame, min_months: int = 3) -> DataFrame:
    """Trend of each product's monthly share of its best month; 0 with too few months.

    A product's array holds one point per month of history. The arrays go through Arrow in
    batches, and each batch is fitted as one padded matrix.
    """
    points = F.array_sort(F.collect_list(F.struct("month_num", "qty")))
    series = (
        monthly_sales(daily)
        .groupBy("product_id")
        .agg(points.alias("points"), F.max("qty").alias("best"))
    )
    shares = F.transform("points.qty", lambda q: q / F.col("best"))
    fits = (F.size("points") >= min_months) & (F.col("best") > 0)
    shown = series.select(
        "product_id",
        F.when(fits, F.col("points.month_num").cast("array<double>"))
        .otherwise(F.array(F.lit(0.0)))
        .alias("months"),
        F.when(fits, shares).otherwise(F.array(F.lit(0.0))).alias("shares"),
        fits.alias("fits"),
    )
    slope = np_round(_slope("months", "shares"), 2)
    return shown.withColumn("slope", slope).select(
        "product_id", F.when(F.col("fits"), F.col("slope")).otherwise(0.0).alias("lt_growth")
    )
