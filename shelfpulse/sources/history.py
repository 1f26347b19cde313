"""Histories that grow every day, read only as far back as a signal looks."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.functions import epoch_of, within
from shelfpulse.functions.columns import SECONDS_PER_DAY
from shelfpulse.sources.market import on_latest


class EpochHistory:
    """A raw table with epoch seconds in `timestamp`, and the reader that makes it clean.

    Day limits are put on the raw column, where they reach the scan and skip row groups; on
    the day that the reader derives they could not. `load` gets the first unshifted day too,
    to leave out the folders of earlier days. `recent`, where given, returns the rows of the
    newest folder, or None for a table without folders by day.
    """

    def __init__(
        self,
        load: Callable[[date | None], DataFrame],
        read: Callable[[DataFrame], DataFrame],
        shift_hours: int,
        recent: Callable[[], DataFrame | None] = lambda: None,
    ):
        self.load, self.read, self.shift_hours, self.recent = load, read, shift_hours, recent

    def all(self) -> DataFrame:
        return self.read(self.load(None))

    def since(self, day: date) -> DataFrame:
        first = epoch_of(day, self.shift_hours)
        raw = self.load(day - timedelta(days=math.ceil(max(self.shift_hours, 0) / 24)))
        return self.read(raw.filter(F.col("timestamp") >= F.lit(first)))

    def between(self, first: date, last: date) -> DataFrame:
        """Rows of the days `first` to `last`."""
        return self.since(first).filter(within(F.col("day"), None, last))

    def newest(self) -> DataFrame:
        """Rows of the newest day: those from its first second on.

        With folders by day only the newest one is asked for that day, and only those that the
        day can lie in are read. Without, it is a scalar subquery over the time column.
        """
        shift = self.shift_hours * 3600
        days = F.floor((F.max("timestamp") + shift) / SECONDS_PER_DAY)
        recent = self.recent()
        if recent is not None:
            day = recent.agg(F.date_from_unix_date(days.cast("int"))).first()[0]
            if day is not None:
                return self.since(day)
        raw = self.load(None)
        first = raw.agg((days * SECONDS_PER_DAY - shift).cast("bigint")).scalar()
        return self.read(raw.filter(F.col("timestamp") >= first))


class DatedHistory:
    """A raw table with a time stamp or date in `column`, and the reader that makes it clean.

    As for `EpochHistory`, limits are put on the raw column and on the folders.
    """

    def __init__(
        self,
        load: Callable[[date | None, date | None], DataFrame],
        read: Callable[[DataFrame], DataFrame],
        column: str = "date",
        recent: Callable[[], DataFrame | None] = lambda: None,
    ):
        self.load, self.read, self.column, self.recent = load, read, column, recent

    def all(self) -> DataFrame:
        return self.read(self.load(None, None))

    def since(self, day: date) -> DataFrame:
        return self.read(self.load(day, None).filter(F.col(self.column) >= F.lit(day)))

    def between(self, first: date, last: date) -> DataFrame:
        """Rows of the days `first` to `last`."""
        time = F.col(self.column)
        inside = (time >= F.lit(first)) & (time < F.lit(last + timedelta(days=1)))
        return self.read(self.load(first, last).filter(inside))

    def newest(self) -> DataFrame:
        """Rows of the newest day, from the newest folder alone where there are folders."""
        recent = self.recent()
        raw = self.load(None, None) if recent is None else recent
        first = raw.agg(F.to_date(F.max(self.column))).scalar()
        return self.read(raw.filter(F.col(self.column) >= first))


class DayHistory:
    """A clean frame with a plain day column."""

    def __init__(self, frame: DataFrame, day: str = "day"):
        self.frame, self.day = frame, day

    def all(self) -> DataFrame:
        return self.frame

    def since(self, day: date) -> DataFrame:
        return self.frame.filter(F.col(self.day) >= F.lit(day))

    def between(self, first: date, last: date) -> DataFrame:
        """Rows of the days `first` to `last`."""
        return self.frame.filter(within(F.col(self.day), first, last))

    def newest(self) -> DataFrame:
        return on_latest(self.frame, self.day)


History = EpochHistory | DatedHistory | DayHistory
