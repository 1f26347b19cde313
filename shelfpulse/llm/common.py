"""Shared tables of a run and access to text in Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.session import CHECKPOINT_DIR, Staging

#: White space of every contract here: blank and the five ASCII controls from tab to return.
SPACES = r"[\x20\x09-\x0D]+"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; where the session names none, as in tests,
    one beside its tables."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


class Scratch:
    """Intermediate tables of one run, as Parquet in the shared folder.

    A written table cuts the lineage and survives lost executors. The shuffle files behind it
    are removed as soon as it is complete, so the disk holds those of one step at a time.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.staging = Staging(spark, shared_root(spark))
        self.paths: dict[int, str] = {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.folder(f"{name}-{uuid.uuid4().hex[:8]}")
        before = self.spark.conf.get(CLEAN_SHUFFLES, "false")
        self.spark.conf.set(CLEAN_SHUFFLES, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEAN_SHUFFLES, before)
        written = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(written)] = path
        return written

    def discard(self, *written: DataFrame) -> None:
        """Delete tables that nothing will read any more."""
        context = self.spark.sparkContext
        for df in written:
            path = context._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df)))
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

    def folder(self, name: str) -> str:
        return f"{self.staging.path}/{name}"


def set_aside(
    docs: DataFrame, own: tuple[str, ...] = ("doc_id", "text"), dropped: tuple[str, ...] = ()
) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """`docs` with all columns but `own` under names that no operator uses, without `dropped`, and
    a function that gives the result's columns their names and order back, with the new columns
    named to it behind them."""
    names = [n for n in docs.columns if n not in dropped]
    inside = {n: n if n in own else f"_input_column_{i}" for i, n in enumerate(names)}

    def quoted(name: str) -> str:
        return f"`{name.replace('`', '``')}`"

    def back(result: DataFrame, *added: str) -> DataFrame:
        return result.select(*(F.col(i).alias(n) for n, i in inside.items()), *added)

    return docs.select(*(F.col(quoted(n)).alias(i) for n, i in inside.items())), back


def plain_text(text: str | Column) -> Column:
    """Missing text counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def one_space(text: Column) -> Column:
    """Every run of white space as one blank."""
    return F.regexp_replace(text, SPACES, " ")


def text_parts(
    batch: pa.RecordBatch, name: str, size: int = 1 << 18
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts of a batch in runs of about `size` bytes: first row, end row, their UTF-8
    bytes, and where each text begins in them (one entry more than texts). Null is empty."""
    for row in range(0, batch.num_rows, 512):  # converted piece by piece, to hold few copies
        column = batch.column(name).slice(row, 512).cast(pa.large_string()).fill_null("")
        n = len(column)
        _, begins, data = column.buffers()
        begins = np.frombuffer(begins, dtype=np.int64)[column.offset : column.offset + n + 1]
        data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
        low = 0
        while low < n:
            high = int(np.searchsorted(begins, begins[low] + size, side="right")) - 1
            high = min(max(high, low + 1), n)
            part = slice(begins[low], begins[high])
            yield row + low, row + high, data[part], begins[low : high + 1] - begins[low]
            low = high


def word_bounds(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end byte of every word of `data`, and the first word of every text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(begins), np.int64)
    letter = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[begins] = True
    before = np.concatenate(([False], letter[:-1])) & ~edge[:-1]
    after = np.concatenate((letter[1:], [False])) & ~edge[1:]
    starts = np.flatnonzero(letter & ~before)
    ends = np.flatnonzero(letter & ~after) + 1
    return starts, ends, np.searchsorted(starts, begins)
