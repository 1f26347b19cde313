"""The option-day rollup kept between runs, so that a run aggregates new days only."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.functions import within
from shelfpulse.operators.sales import option_days
from shelfpulse.sources.ledger import Ledger

#: Days before a run whose lines may still change; they are aggregated anew by the next run.
LATE_DAYS = 7

Lines = Callable[[date, date], DataFrame]


class KeptRollup:
    """Option days of all order lines up to the last run, in folders by batch and day.

    A ledger says which batch holds which days; every day belongs to one. A run reads the lines
    of the days that no batch holds and of the last `late_days`, writes them as a new batch, and
    enters it in place of what it replaces. The record takes effect at once, so a run that
    fails changes nothing, and one that is repeated begins from the same state.
    """

    def __init__(self, spark: SparkSession, path: str, late_days: int = LATE_DAYS):
        self.spark, self.path, self.late_days = spark, path.rstrip("/"), late_days
        self.ledger = Ledger(spark, f"{self.path}/_ledger")

    def batches(self) -> list[tuple[str, date, date]]:
        """Name, first and last day of each batch, by day."""
        found = self.ledger.newest() or []
        return [(name, date.fromisoformat(a), date.fromisoformat(b)) for name, a, b in found]

    def missing(self, start: date, end: date) -> tuple[date, date]:
        """The days from `start` to before `end` that have to be read: those behind the last
        finished day, the late ones before it, and all where the beginning is not held."""
        batches = self.batches()
        last = end - timedelta(days=1)
        if not batches or start < batches[0][1] or start > batches[-1][2]:
            return start, last
        return max(start, min(batches[-1][2] + timedelta(days=1 - self.late_days), end - timedelta(days=self.late_days))), last

    def update(self, lines: Lines, start: date, end: date) -> DataFrame:
        """The option days from `start` up to `end`, as `option_days` of all its lines.

        lines(a, b): the order lines bought from midnight of `a` to midnight of `b`. The day
        `end` is not over: its lines are aggregated for this run and not kept.
        """
        first, last = self.missing(start, end)
        if first <= last:
            self._add(option_days(lines(first, last + timedelta(days=1))), first, last, start)
        today = option_days(lines(end, end))
        return self.read(start, last).unionByName(today.filter(F.col("day") == F.lit(end)))

    def _add(self, days: DataFrame, first: date, last: date, start: date) -> None:
        name = uuid.uuid4().hex
        # The line at midnight behind the last day belongs to the next one.
        inside = days.filter(within(F.col("day"), first, last))
        inside.repartition("day").write.partitionBy("day").parquet(f"{self.path}/batch={name}")
        one = timedelta(days=1)
        kept = []
        for old, a, b in self.batches():
            if b >= start:
                kept += [(old, a, min(b, first - one))] if a < first else []
                kept += [(old, max(a, last + one), b)] if b > last else []
        record = sorted([*kept, (name, first, last)], key=lambda x: x[1])
        self.ledger.add([(n, a.isoformat(), b.isoformat()) for n, a, b in record])
        used = {f"batch={n}" for n, *_ in record} | {f"batch={n}" for n, *_ in self._before()}
        for old in self.ledger.folders(self.path):
            if old.startswith("batch=") and old not in used:
                self.ledger.delete(f"{self.path}/{old}")

    def _before(self) -> list:
        """The batches of the record before the newest, which a reader may still use."""
        numbers = self.ledger.numbers()
        return self.ledger.read(numbers[1]) if len(numbers) > 1 else []

    def read(self, start: date, last: date) -> DataFrame:
        """The kept option days from `start` to `last`; days outside are not opened."""
        used = [(n, max(a, start), min(b, last)) for n, a, b in self.batches() if b >= start and a <= last]
        empty = self.spark.createDataFrame([], SCHEMA)
        paths = [f"{self.path}/batch={n}" for n, *_ in used]
        if not paths:
            return empty
        found = self.spark.read.schema(f"{SCHEMA}, batch string").option("basePath", self.path).parquet(*paths)
        held = reduce(lambda x, y: x | y, [(F.col("batch") == n) & within(F.col("day"), a, b) for n, a, b in used])
        return found.filter(held).select(*empty.columns)


SCHEMA = (
    "product_id bigint, barcode string, variant_name string, product_name string, category_m string, "
    "category_s string, day date, qty double, last_sold_at timestamp"
)
