"""Removal of lines that follow a template which recurs across documents.

A parse tree of fixed depth groups lines: first by number of tokens, then by their leading
tokens, where a token with a digit counts as variable. Inside a leaf, a token that few documents
have at its position is variable too; what stays makes the template. All of it is grouping and
joining on hashes; a leaf that a third of all lines fall into is counted like any other.

A template recurs if many documents hold it that are otherwise different; copies of one document
count once, however many they are, and further copies never lower the count. A document is known
by its lines outside the tested leaf: the longest of them as it stands, and all of them without
their digits. One that has no others is known by all its lines as they stand. The line stays in
the document with the smallest doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.llm.common import SPACES, Scratch, plain_text, set_aside
from shelfpulse.llm.sieve import Sieve
from shelfpulse.llm.skew import heavy_keys, salted_join

LEADING = 3
MIN_DOCUMENTS = 10
#: At least this share of a template's tokens is constant.
CONSTANT = 0.5
VARIABLE = "<*>"
_KEY, _DROP = "_text_key", "_drop"
_KEYS = ["leaf", "at", "token"]
ADDED = ("n_lines", "n_dropped")


def _tokens(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), SPACES)


def _leaf(tokens: Column) -> Column:
    """Without a lambda, which could not share the tokens with the other columns."""
    lead = [F.get(tokens, F.lit(i)) for i in range(LEADING)]
    return F.xxhash64(F.size(tokens), *[F.when(t.rlike("[0-9]"), VARIABLE).otherwise(t) for t in lead])


def parsed_lines(keyed: DataFrame) -> DataFrame:
    """Lines that have a token: doc_id, text key, line number, tokens, leaf."""
    lines = keyed.select("doc_id", _KEY, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return lines.withColumn("tokens", _tokens(F.col("line"))).withColumn("leaf", _leaf(F.col("tokens")))


def known_by(lines: DataFrame) -> DataFrame:
    """doc_id, text key, leaf and `document`, by which holders of a leaf are told apart, once
    per leaf of a document."""
    exact = F.xxhash64("tokens")
    digits = F.col("line").rlike("[0-9]")
    plain = F.when(digits, F.xxhash64(F.translate(F.array_join("tokens", " "), "0123456789", ""))).otherwise(exact)
    per_leaf = lines.select(
        "doc_id",
        _KEY,
        "leaf",
        # Number of tokens, then 40 bits of the line's hash: the greatest is the longest line.
        (F.shiftleft(F.size("tokens").cast("bigint"), 40) + F.shiftrightunsigned(exact, 24)).alias("longest"),
        exact.alias("exact"),
        plain.alias("plain"),
    )
    # Sums beside the exclusive or, in which a line that comes twice would vanish.
    per_leaf = per_leaf.groupBy("doc_id", _KEY, "leaf").agg(
        F.max("longest").alias("longest"),
        F.bit_xor("exact").alias("exact"),
        F.bit_xor("plain").alias("plain"),
        F.sum(F.shiftright("plain", 24)).alias("sum"),
    )
    whole = Window.partitionBy("doc_id", _KEY)
    top = F.max(F.struct("longest", "leaf")).over(whole)
    second = F.max(F.when(F.col("leaf") != F.col("top.leaf"), F.col("longest"))).over(whole)
    other = F.when(F.col("leaf") != F.col("top.leaf"), F.col("top.longest")).otherwise(second)
    all_plain, all_sum = F.bit_xor("plain").over(whole), F.sum("sum").over(whole)
    others = F.xxhash64(other, all_plain.bitwiseXOR(F.col("plain")), all_sum - F.col("sum"))
    found = per_leaf.withColumn("top", top)
    return found.select(
        "doc_id",
        _KEY,
        "leaf",
        F.when(other.isNull(), F.xxhash64("exact", "sum")).otherwise(others).alias("document"),
    )


def recurring(found: DataFrame, by: list[str], min_documents: int) -> DataFrame:
    """Groups that many otherwise different documents hold, with the first of these and `n`, the
    number of rows."""
    different = found.groupBy(*by, "document").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    return (
        different.groupBy(*by)
        .agg(F.count("*").alias("kinds"), F.min("first_id").alias("first_id"), F.sum("n").alias("n"))
        .filter(F.col("kinds") >= min_documents)
        .select(*by, "first_id", "n")
    )


def templates(keyed: DataFrame, scratch: Scratch, min_documents: int) -> tuple[DataFrame, DataFrame]:
    """Lines in leaves that recur, with their template; and the templates that recur."""
    lines = parsed_lines(keyed.filter("doc_id IS NOT NULL"))
    documents = scratch.table(known_by(lines), "known-by")
    leaves = scratch.table(recurring(documents, ["leaf"], min_documents).select("leaf"), "leaves")
    sizes = scratch.table(documents.groupBy("leaf").agg(F.count("*").alias("n")), "sizes")
    heavy, deal = heavy_keys(sizes, ["leaf"]), F.xxhash64("doc_id", _KEY)
    documents = scratch.table(salted_join(documents, leaves, ["leaf"], heavy, deal, "left_semi"), "holders")

    shared = scratch.table(
        salted_join(lines.drop("line"), leaves, ["leaf"], heavy, deal, "left_semi"),
        "lines",
    )
    words = shared.select("doc_id", "leaf", F.posexplode("tokens").alias("at", "token"))
    words = words.withColumn("token", F.xxhash64("token"))
    constant = scratch.table(
        words.groupBy(*_KEYS).agg(F.count_distinct("doc_id").alias("n"))
        .filter(F.col("n") >= min_documents).select(*_KEYS, F.lit(1).alias("fixed"), "n"),
        "constant",
    )
    # Equal lines of a leaf have equal templates, so these are made once per different line.
    name = F.xxhash64("tokens").alias("line")
    different = shared.groupBy("leaf", "tokens").agg(F.count("*").alias("n"))
    different = scratch.table(different.select("*", name), "different")
    words = different.select("leaf", "line", F.posexplode("tokens").alias("at", "token"))
    words = words.withColumn("token", F.xxhash64("token"))
    fixed = F.when(F.col("fixed") == 1, F.col("token"))
    made = (
        salted_join(words, constant.drop("n"), _KEYS, heavy_keys(constant, _KEYS), F.col("line"), "left")
        .groupBy("leaf", "line")
        .agg(
            F.xxhash64(F.array_sort(F.collect_list(F.struct("at", fixed.alias("fixed"))))).alias("template"),
            F.avg(fixed.isNotNull().cast("int")).alias("share"),
        )
        .filter(F.col("share") >= CONSTANT)
        .drop("share")
    )
    made, by = scratch.table(made, "made"), ["leaf", "line"]
    held = shared.select("doc_id", _KEY, "line_no", "leaf", name)
    deal = F.xxhash64("doc_id", "line_no")
    shapes = (
        salted_join(held, made, by, heavy_keys(different, by), deal)
        .join(documents, ["doc_id", _KEY, "leaf"])
        # Lines of rows that come as often count as alike.
        .groupBy("doc_id", _KEY, "line_no", "leaf", "template", "document")
        .agg(F.count("*").alias("times"))
        .withColumn("template", F.xxhash64("template", "times"))
    )
    shapes = scratch.table(shapes.select("doc_id", _KEY, "line_no", "leaf", "template", "document"), "shapes")
    found = recurring(shapes, ["leaf", "template"], min_documents)
    return shapes, scratch.table(found, "recurring")


def drop_recurring(
    docs: DataFrame, scratch: Scratch, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """`docs` without the lines of recurring templates, with n_lines and n_dropped.

    Lines end at a line feed. Null text is empty and has no line; blank lines stay. Rows with
    equal doc_id count as one document; a row with a null doc_id keeps its lines. Input columns
    named like the added ones are replaced.
    """
    docs, back = set_aside(docs, dropped=ADDED)
    keyed = docs.withColumn("text", plain_text("text")).withColumn(_KEY, F.xxhash64("text"))
    shapes, found = templates(keyed.select("doc_id", "text", _KEY), scratch, min_documents)
    by = ["leaf", "template"]
    held = salted_join(shapes, found.drop("n"), by, heavy_keys(found, by), F.xxhash64("doc_id", "line_no"))
    drops = (
        held.filter("doc_id > first_id")
        .groupBy("doc_id", _KEY).agg(F.collect_set("line_no").alias(_DROP))
        .select(F.col("doc_id").alias("_drop_id"), F.col(_KEY).alias("_drop_key"), _DROP)
    )
    drops = scratch.table(drops, "drops")
    sieve = Sieve(drops.select(F.col("_drop_id").alias("doc_id")), ["doc_id"], scratch)
    same = (F.col("doc_id") == F.col("_drop_id")) & (F.col(_KEY) == F.col("_drop_key"))
    joined = sieve.left_join(keyed, drops, same)
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda line, i: ~F.array_contains(_DROP, i))
    n_dropped = F.coalesce(F.size(_DROP), F.lit(0))
    n_dropped = F.when(F.col(_DROP).isNull(), 0).otherwise(n_dropped).cast("bigint")
    text = F.when(F.col(_DROP).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(F.col("text") == "", 0).otherwise(F.size(lines)).cast("bigint")
    done = joined.select(
        *[text.alias("text") if n == "text" else F.col(n) for n in docs.columns],
        n_lines.alias("n_lines"),
        n_dropped.alias("n_dropped"),
    )
    return back(done, *ADDED)
