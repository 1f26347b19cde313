"""Session settings and the durable intermediate tables of a run."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SETTINGS = {
    # Dates are plain days and epochs are shifted explicitly, so one fixed zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Plans are built from thousands of small expressions; noting the Python line of each one
    # takes longer than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app: str = "shelfpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine expects; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def together(spark: SparkSession, jobs: Sequence[Callable[[], Any]]) -> list[Any]:
    """Run actions that do not depend on each other at the same time, so that their tasks
    share the executors and small jobs do not wait for each other."""
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in running]


class Staging:
    """Writes shared intermediate results once, as Parquet in the cluster's shared folder.

    A staged table cuts the lineage, survives the loss of executors, and gives later
    plans true sizes, so joins with it are planned from statistics, not guesses.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        root = root or spark.conf.get(CHECKPOINT_DIR, None)
        if not root:
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        self.path = f"{root.rstrip('/')}/shelfpulse-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write `df` under `name` and read it back."""
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def tables(self, frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Stage independent frames at the same time."""
        jobs = [partial(self.table, df, name) for name, df in frames.items()]
        return dict(zip(frames, together(self.spark, jobs), strict=True))

    def drop(self) -> None:
        """Delete everything this run staged."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)
