"""Prefix trie of conversations by the recursion of van Emde Boas.

A sequence of up to 2^k turns is cut at half depth. The first halves make the upper trie; the
second halves make the lower forest, one tree per cut prefix. Both are sequences of 2^(k-1) turns
at most, so both are cut again at the same time, and after k rounds every piece is one turn: a
node below its parent. A cut prefix is named from the name of the prefix it continues and the
name of its own half, and halves are named from their halves, so naming takes k rounds with half
as many rows each. Names are 128 bits of SHA-256, equal for equal sequences.

Totals go upward the same way, from the widest cut to the narrowest: what lies below a cut is
summed per cut prefix and grafted onto that node, so afterwards upper trie and lower forest need
nothing of each other any more. k rounds give every node the sum of its subtree.

Rows are single turns throughout: no conversation and no node's members are gathered, and all
sums are combined before the shuffle. Only the depth and counts of heavy keys reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfpulse.llm.common import Scratch, plain_text
from shelfpulse.llm.skew import heavy_keys, salted_join

#: Conversations of so many ids share the beginning of one.
FAMILY = 20
#: A rebuilt conversation takes fewer than this many turns from its family's first.
HEADS = 4
#: Bits of the ranges of ids whose list is written as one string.
ID_BITS = 12

def _root_name() -> Column:
    return F.lit(bytearray(16))


def _name(*parts: Column) -> Column:
    return F.unhex(F.substr(F.sha2(F.concat(*parts), 256), F.lit(1), F.lit(32)))


def numbered_turns(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns of each conversation, numbered from 0 by turn, null first, and by the name of their
    role and text where turns are equal: (conv_id, part, place, name, words) and the parts
    (conv_id, part, before, n). The number is place + before.

    Rows are dealt by ranges of conversation and turn, so that a conversation of any length is
    sorted by many tasks; `before` is the number of its turns in earlier ranges.
    """
    role, text = plain_text("role"), plain_text("text")
    named = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        _name(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8")).alias("name"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )
    order = ["conv_id", "turn", "name"]
    dealt = named.repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id().alias("row")
    turns = scratch.table(dealt.select("conv_id", "name", "words", F.spark_partition_id().alias("part"), row), "turns")
    parts = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    return turns, scratch.table(parts.select("*", before.alias("before")), "parts")


def rebuilt(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with the first h turns of conversation c - c % 20 in place of its own
    first h, h = crc32 of c modulo 4: its turns (conv_id, i, name, words, last) and the
    conversations (conv_id, length)."""
    turns, parts = numbered_turns(conversations, scratch)
    convs = parts.groupBy("conv_id").agg(F.sum("n").alias("n"))
    convs = convs.select(
        "*",
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"),
    )
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    length = taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = convs.join(bases, "base", "left").select("conv_id", "base", "h", taken.alias("taken"), length.alias("length"))
    convs = scratch.table(convs, "conversations")

    # A conversation has at most one row per part, so none is heavy in these two joins.
    placed = turns.join(parts.drop("n").join(convs, "conv_id"), ["conv_id", "part"])
    placed = placed.withColumn("i", F.col("before") + F.col("row") - F.col("first"))
    shifted = F.col("i") - F.col("h") + F.col("taken")
    own = placed.filter("i >= h").select("conv_id", shifted.alias("i"), "name", "words", "length")
    heads = placed.filter(F.col("i") < HEADS - 1).select(F.col("conv_id").alias("base"), "i", "name", "words")
    borrowed = heads.join(convs, "base").filter("i < taken").select("conv_id", "i", "name", "words", "length")
    rows = own.unionByName(borrowed).select("conv_id", "i", "name", "words", (F.col("i") + 1 == F.col("length")).alias("last"))
    return scratch.table(rows, "sequences"), convs.select("conv_id", "length")


def _named_nodes(rows: DataFrame, rounds: int, scratch: Scratch) -> DataFrame:
    """`rows` with the name of the prefix they end (node), that of its parent, and `cuts`: per
    round the cut prefix below which the row lies in that round, or null."""
    blocks = rows.select("conv_id", F.col("i").alias("j"), F.col("name").alias("whole"))
    halves = []
    for _ in range(rounds):
        left, right = (F.max(F.when(F.col("j") % 2 == side, F.col("whole"))) for side in range(2))
        pairs = blocks.groupBy("conv_id", F.shiftright("j", 1).alias("j")).agg(
            left.alias("left"), right.alias("right"), (F.max(F.col("j") % 2) == 1).alias("two")
        )
        # Half as many rows each time; null where a half is not full.
        pairs = scratch.table(pairs.select("*", _name("left", "right").alias("whole")), "halves")
        halves.append(pairs.drop("whole", "right"))
        blocks = pairs.select("conv_id", "j", "whole")

    top = blocks.select(
        "conv_id", "j", _root_name().alias("root"), _name(_root_name(), F.col("whole")).alias("end"),
        F.array().cast("array<binary>").alias("cuts"),
    )
    for k, pairs in enumerate(reversed(halves)):
        cut = _name(F.col("root"), F.col("left"))

        def piece(j: Column, root: Column, end: Column, below: Column) -> Column:
            cuts = F.concat("cuts", F.array(below))
            return F.struct(j.alias("j"), root.alias("root"), end.alias("end"), cuts.alias("cuts"))

        nothing = F.lit(None).cast("binary")
        upper = piece(F.col("j") * 2, F.col("root"), F.col("cut"), nothing)
        lower = piece(F.col("j") * 2 + 1, F.col("cut"), F.col("end"), F.col("cut"))
        both = F.when(F.col("two"), F.array(upper, lower)).otherwise(F.array(upper))
        joined = top.join(pairs, ["conv_id", "j"]).withColumn("cut", cut)
        top = joined.select("conv_id", F.explode(both).alias("p")).select("conv_id", "p.*")
        if k % 4 == 3:  # keeps plans short where conversations are long
            top = scratch.table(top, "pieces")
    top = top.select("conv_id", F.col("j").alias("i"), F.col("end").alias("node"), F.col("root").alias("parent"), "cuts")
    return rows.drop("name").join(top, ["conv_id", "i"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined lists of each node; rows come sorted by node and range of ids."""
    node, state = None, hashlib.sha256()
    for batch in batches:
        done: tuple[list, list] = ([], [])
        for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids"), strict=True):
            if name == node:
                state.update(b",")
            else:
                if node is not None:
                    done[0].append(node)
                    done[1].append(state.hexdigest())
                node, state = name, hashlib.sha256()
            state.update(ids.as_py().encode())
        yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.binary()), pa.array(done[1], pa.string())], ["node", "ends"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends"])


def _ends(members: DataFrame) -> DataFrame:
    """node and the digest of the ascending ids that end there. One string holds the ids of one
    range, so a node with any number of them costs one row per range; the strings are then hashed
    one after the other, which a digest of a list cannot avoid."""
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    ranges = members.groupBy("node", F.shiftright("conv_id", ID_BITS).alias("range")).agg(F.array_join(ids, ",").alias("ids"))
    dealt = ranges.repartition("node").sortWithinPartitions("node", "range").select("node", "ids")
    return dealt.mapInArrow(_digests, "node binary, ends string")


def trie(rows: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per distinct prefix of the sequences. rows: conv_id, i (0, 1, ... without gaps),
    name (of the turn), words, last; convs: conv_id, length, each id once."""
    longest = convs.agg(F.max("length")).first()[0]
    rounds = max((longest or 1) - 1, 0).bit_length()
    named = scratch.table(_named_nodes(rows, rounds, scratch), "named")
    nodes = named.groupBy("node", "parent", (F.col("i") + 1).alias("depth"), "words", "cuts").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")
    )
    saved = (F.col("n_convs") - 1) * F.col("words")
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    state = nodes.join(children, "node", "left").select(
        "node", "parent", "depth", "cuts", "conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("bigint").alias("n_leaves"),
        saved.alias("saved_tokens"),
    )
    state = scratch.table(state, "nodes")
    root = _root(state, convs)
    for k in range(rounds):
        cut = F.col("cuts")[k]
        below = state.filter(cut.isNotNull()).groupBy(cut.alias("node")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
        )
        grafted = state.join(below, "node", "left")
        for total, more in (("n_leaves", "more_leaves"), ("saved_tokens", "more_saved")):
            grafted = grafted.withColumn(total, F.col(total) + F.coalesce(more, F.lit(0)))
        state = scratch.table(grafted.drop("more_leaves", "more_saved"), "grafted")
    state = state.drop("cuts").unionByName(root)

    members = named.filter("last").select("node", "conv_id")
    turnless = convs.filter("length = 0").select(_root_name().alias("node"), "conv_id")
    ends = _ends(members.unionByName(turnless))
    parents = state.filter("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    counts = state.select(F.col("node").alias("parent"), F.col("n_children").alias("n"))
    found = salted_join(state, parents, ["parent"], heavy_keys(counts, ["parent"]), F.xxhash64("node"), "left")
    nobody = hashlib.sha256(b"").hexdigest()
    return found.join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(nobody)).alias("ends_sha256"),
    )


def _root(state: DataFrame, convs: DataFrame) -> DataFrame:
    """The root's row, or none without conversations: below it lies everything."""
    everyone = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    below = state.agg(
        F.coalesce(F.sum((F.col("depth") == 1).cast("bigint")), F.lit(0)).alias("n_children"),
        F.coalesce(F.sum("n_leaves"), F.lit(0)).alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"),
    )
    counted, summed = everyone.first(), below.first()  # six numbers
    root = state.sparkSession.range(1).select(
        _root_name().alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(counted.conv_id).cast("bigint").alias("conv_id"), F.lit(counted.n_convs).cast("bigint").alias("n_convs"),
        F.lit(summed.n_children).cast("bigint").alias("n_children"),
        # A root without children is a leaf itself.
        F.lit(max(summed.n_leaves, 1)).cast("bigint").alias("n_leaves"),
        F.lit(summed.saved_tokens).cast("bigint").alias("saved_tokens"),
    )
    return root.filter("conv_id IS NOT NULL")


def conversation_trie(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """The trie of the rebuilt conversations (see `rebuilt`), one row per distinct sequence of
    first turns: conv_id (smallest member), depth, parent_conv_id (root: null), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    A null role or text is empty. Rows without conv_id belong to no conversation and are left
    out. Repeated rows are turns of their own; equal turns of one conversation with different
    role or text come in the order of their names. An empty table has no root.
    """
    rows, convs = rebuilt(conversations, scratch)
    return trie(rows, convs, scratch)
