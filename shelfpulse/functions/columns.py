"""Column expressions with the numeric and null rules the published results need.

All of them stay inside generated JVM code.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def np_round(value: Column, digits: int) -> Column:
    """Scale, round half to even, scale back.

    `round` and `bround` work on the decimal text of the double, so they turn 0.575
    into 0.58; this gives 0.57.
    """
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def pdiv(numerator: Column, denominator: Column) -> Column:
    """Division that gives a signed infinity for x/0 and null for 0/0, never an error."""
    by_zero = F.when(numerator > 0, F.lit(float("inf"))).when(numerator < 0, F.lit(float("-inf")))
    return F.when(denominator == 0, by_zero).otherwise(F.try_divide(numerator, denominator))


def not_in_keep_null(value: Column, unwanted: Iterable) -> Column:
    """NOT IN that keeps rows whose value is null."""
    unwanted = list(unwanted)
    if not unwanted:
        return F.lit(True)
    return F.coalesce(~value.isin(unwanted), F.lit(True))


def within(value: Column, low: Column | date | None, high: Column | date | None) -> Column:
    """Inclusive range; an open end is None."""
    bounds = []
    if low is not None:
        bounds.append(value >= (low if isinstance(low, Column) else F.lit(low)))
    if high is not None:
        bounds.append(value <= (high if isinstance(high, Column) else F.lit(high)))
    result = F.lit(True)
    for bound in bounds:
        result = result & bound
    return result


def timestamp_from_epoch(seconds: Column, shift_hours: int = 0) -> Column:
    """Epoch seconds, moved by a fixed number of hours, as a timestamp."""
    return F.timestamp_seconds(seconds + shift_hours * 3600)


def day_from_epoch(seconds: Column, shift_hours: int = 0) -> Column:
    """Epoch seconds, moved by a fixed number of hours, as a day in any session zone."""
    days = F.floor((seconds + shift_hours * 3600) / SECONDS_PER_DAY)
    return F.date_from_unix_date(days.cast("int"))


def epoch_of(day: date, shift_hours: int = 0) -> int:
    """First epoch second of `day` in the shifted clock.

    Comparing the raw column with this number lets the file scan skip row groups, which
    a comparison of the derived day cannot.
    """
    midnight = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
    return int(midnight.timestamp()) - shift_hours * 3600


def month_index(day: Column, first: Column) -> Column:
    """Whole calendar months from `first` to `day`."""
    return (F.year(day) - F.year(first)) * 12 + F.month(day) - F.month(first)


def one_line(text: Column) -> Column:
    """Every line break becomes one space; CR LF counts as one break."""
    return F.regexp_replace(text, "\r\n|\r|\n", " ")


def strip_tabs(text: Column) -> Column:
    return F.translate(text, "\t", "")


def steady_mean(value: Column) -> Column:
    """The mean of all values that are not null, infinite ones included.

    A sum of doubles depends on the order in which partitions arrive, which is enough to flip a
    two-digit rounding. Values are therefore split: millionths add up as whole numbers, which
    takes in all of a value that was rounded to at most six digits; what is finer or larger is
    added as doubles. Infinities of both signs together have no mean.
    """
    value = value.cast("double")
    small = F.abs(value) < 1e12
    whole = F.when(small, F.rint(value * 1e6))
    finer = F.when(small, value - whole / 1e6).otherwise(value)
    total = F.sum(whole.cast("decimal(18,0)")).cast("double") / 1e6
    mean = F.try_divide(F.coalesce(total, F.lit(0.0)) + F.sum(finer), F.count(value))
    return F.when(~F.isnan(mean), mean)
