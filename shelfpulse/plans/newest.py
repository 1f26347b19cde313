"""The newest row per key of a growing history, kept between runs as one table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.operators.stock import newest_records
from shelfpulse.plans.rollup import LATE_DAYS
from shelfpulse.sources.history import History
from shelfpulse.sources.ledger import Ledger
from shelfpulse.sources.market import newest_crawls


class KeptNewest:
    """One row per key, brought up to date by each run from the days since the last one.

    `reduce` takes rows to the newest of each key; it must give the same for the newest of parts
    as for the whole, and keep the columns it needs. `time` is the column of a row's time. A run
    reads the kept table and the rows from `late_days` before the newest day it has seen, and
    writes a new version, which a record moved into place makes the current one. A run that fails
    changes nothing, and rows that are read twice count once. Rows without a time, and those that
    arrive over `late_days` late, are seen only by the first run; delete the folder to begin anew.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        reduce: Callable[[DataFrame], DataFrame],
        time: str,
        late_days: int = LATE_DAYS,
    ):
        self.spark, self.path, self.reduce = spark, path.rstrip("/"), reduce
        self.time, self.late_days = time, late_days
        self.ledger = Ledger(spark, f"{self.path}/_ledger")

    def update(self, history: History, today: date) -> DataFrame:
        """The newest row per key of all the history. Days behind `today`, which a wrong clock may
        have written, count, but the next run reads from `today` on all the same."""
        record = self.ledger.newest()
        if record is None or record["seen"] is None:
            rows = history.all()
        else:
            seen = date.fromisoformat(record["seen"])
            rows = history.since(seen - timedelta(days=self.late_days))
            rows = self.read(record).unionByName(rows, allowMissingColumns=True)
        newest = self.reduce(rows)
        version = uuid.uuid4().hex
        newest.write.parquet(f"{self.path}/version={version}")
        written = self._version(version)
        last = written.agg(F.to_date(F.max(self.time))).first()[0]
        seen = min(last, today).isoformat() if last else None
        self.ledger.add({"version": version, "seen": seen})
        self._clean()
        return written

    def read(self, record: dict | None = None) -> DataFrame:
        """The kept table, as of the newest record."""
        return self._version((record or self.ledger.newest())["version"])

    def _version(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/version={name}")

    def _clean(self) -> None:
        """Delete versions but those of the two newest records; a reader may still use the older."""
        used = {f"version={self.ledger.read(n)['version']}" for n in self.ledger.numbers()[:2]}
        for name in self.ledger.folders(self.path):
            if name.startswith("version=") and name not in used:
                self.ledger.delete(f"{self.path}/{name}")


def kept_stock(spark: SparkSession, path: str, late_days: int = LATE_DAYS) -> KeptNewest:
    """The newest stock record per barcode."""
    return KeptNewest(spark, path, newest_records, "recorded_at", late_days)


def kept_crawls(spark: SparkSession, path: str, late_days: int = LATE_DAYS) -> KeptNewest:
    """The newest crawl result per competitor and product."""
    return KeptNewest(spark, path, newest_crawls, "update_date", late_days)
