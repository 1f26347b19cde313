"""Exact deduplication against a persistent index of digests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfpulse.llm.common import Scratch, one_space, plain_text


def text_digest(text: str = "text"):
    """SHA-256 of the UTF-8 text with every run of white space as one blank; null is empty."""
    return F.sha2(one_space(plain_text(text)), 256)


class DigestIndex:
    """Digests of all texts seen so far, as Parquet in `buckets` buckets by digest, each file
    sorted by it.

    The files stay at `path`; any later session opens them with the same number of buckets. A
    join on the digest reads the buckets as they lie: only the new rows are shuffled. A digest
    keeps the document it came with first; later batches never replace it.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark = spark
        self.path = path
        self.buckets = buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, docs: DataFrame, scratch: Scratch) -> DataFrame:
        """Enter a batch and tell each of its rows which document stays.

        Returns doc_id, keep_id, group_size (rows of the batch with this text), kept,
        text_sha256, one row per row of `docs`. Of equal texts in one batch the smallest doc_id
        stays, unless the index knows the text already: then its document stays and none of the
        batch does. Null doc_ids count as larger than all others; a group that has no other
        keeps a null id, and its rows are kept. Equal rows with the kept id are all `kept`.
        Adding the same batch again, as after a failure, enters nothing.
        """
        rows = scratch.table(
            docs.select("doc_id", F.unhex(text_digest()).alias("digest")), "digests"
        )
        groups = rows.groupBy("digest").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("group_size")
        )
        groups = scratch.table(groups, "groups")
        new = groups.hint("merge").join(self.table(), "digest", "left_anti")
        # One task per bucket, so that each append adds one sorted file to it.
        (
            new.select("digest", F.col("first_id").alias("keep_id"))
            .repartition(self.buckets, "digest")
            .write.insertInto(self.name)
        )
        groups = groups.hint("merge").join(self.table(), "digest")
        return rows.join(groups, "digest").select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def deduplicate(docs: DataFrame, scratch: Scratch, buckets: int = 64) -> DataFrame:
    """`docs` as the first batch of a new index in the scratch folder."""
    index = DigestIndex(docs.sparkSession, scratch.folder("index"), buckets)
    return index.add(docs, scratch)
