"""The corpus pipeline: quality, line, near-copy and passage filters, then packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfpulse.llm import line_dedup, packing, quality, simhash_dedup, substring_dedup
from shelfpulse.llm.common import Scratch, set_aside

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, labels, Scratch(spark))


def without_template_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of templates that recur; none is dropped."""
    own, back = set_aside(docs)
    return back(line_dedup.drop_recurring(own, Scratch(spark)))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of four-word shingles at most 4 bits apart, the one
    with the smallest doc_id; rows without an id stay."""
    return simhash_dedup.keep_one(docs, Scratch(spark))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words that an earlier one has."""
    own, back = set_aside(docs)
    return back(substring_dedup.remove_repeats(own, Scratch(spark)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("line dedup", without_template_lines),
    ("SimHash near-dedup", one_of_each_group),
    ("substring dedup", without_repeated_passages),
    ("packing", packed),
]

#: No SQL: the classifier is trained and the packer tokenises.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
