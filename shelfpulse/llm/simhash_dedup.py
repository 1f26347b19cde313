"""Near-duplicate documents by SimHash, found through popcounts of fingerprint segments.

A 64-bit fingerprint becomes a lattice point: the number of ones in each of its 32 segments of
2 bits. One differing bit moves the point by at most one step, so the Manhattan distance of two
points is at most the Hamming distance of their fingerprints. Within `MAX_BITS` = 4 bits, one of
the two halves (16 segments each) is at most 2 steps apart, and two points 2 steps apart have a
lattice point in common that is at most one step from either. So every fingerprint enters, for
each half, the cell of its own point and those one step away (25 on average); fingerprints that
share a cell are compared exactly. Of two random fingerprints about one pair in 25,000 does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.common import Scratch, plain_text, set_aside
from shelfpulse.llm.components import components
from shelfpulse.llm.skew import heavy_keys, salted_join

SHINGLE = 4
SEED = 42
MAX_BITS = 4
#: A cell with more members is dealt out to pairs of blocks of about this many.
BLOCK = 4096

_HALF_SEGMENTS = 16
_STEPS = 3 ** np.arange(_HALF_SEGMENTS, dtype=np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of `text`: lower-case A-Z, words joined by one blank, XXH64
    with seed 42, repeats counted. A text of fewer words is one shingle; no words give zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(len(words) - shingle + 1, 1)
    ends = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist(), strict=True)],
        dtype="<u8",
    )
    ones = np.zeros(64, dtype=np.int64)
    for part in range(0, n, 8192):
        bits = np.unpackbits(hashes[part : part + 8192].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int, *kept: str):
    names = ["doc_id", *kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = np.fromiter(
                (fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts)
            )
            columns = [*(batch.column(n) for n in names), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "print"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and `print`, the fingerprint as a signed 64-bit number, of every row."""
    return docs.select("doc_id", "text").mapInArrow(
        _fingerprints(shingle), "doc_id bigint, print bigint"
    )


def cells(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and cell of every cell that a fingerprint enters."""
    prints = prints.view(np.uint64)
    rows, found = [], []
    everyone = np.arange(len(prints))
    for half in range(2):
        pairs = np.stack(
            [prints >> np.uint64(32 * half + 2 * i) & np.uint64(3) for i in range(_HALF_SEGMENTS)]
        )
        ones = np.bitwise_count(pairs).astype(np.int64)
        own = _STEPS @ ones + half * 3**_HALF_SEGMENTS
        rows.append(everyone)
        found.append(own)
        for i, step in enumerate(_STEPS):
            for inside, cell in ((ones[i] < 2, own + step), (ones[i] > 0, own - step)):
                rows.append(everyone[inside])
                found.append(cell[inside])
    return np.concatenate(rows), np.concatenate(found)


def _enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("print").to_numpy()
        row, cell = cells(prints)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(prints[row])], ["cell", "print"])


def forest(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the fingerprints within `max_bits` of each other."""
    left = np.arange(len(prints))
    edges = []
    while len(left):
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = np.bitwise_count(prints[left] ^ prints[at]) <= max_bits
            edges.extend((at, x) for x in left[near])
            todo.extend(left[near])
            left = left[~near]
    return edges


def _compare(max_bits: int):
    def links(group: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        begin = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        size = np.diff(np.append(begin, len(group)))
        a, b = [], []
        low = np.repeat(np.where(size <= 8, begin, -1), size)
        for lag in range(1, 8):  # small groups: every pair at once
            same = (low[lag:] == low[:-lag]) & (low[lag:] >= 0)
            near = np.flatnonzero(same)
            near = near[np.bitwise_count(prints[near] ^ prints[near + lag]) <= max_bits]
            a.append(near)
            b.append(near + lag)
        for i in np.flatnonzero(size > 8):
            edges = forest(prints[begin[i] : begin[i] + size[i]], max_bits)
            if edges:
                pairs = np.array(edges) + begin[i]
                a.append(pairs[:, 0])
                b.append(pairs[:, 1])
        a, b = np.concatenate(a), np.concatenate(b)
        ends = prints.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[a]), pa.array(ends[b])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[np.ndarray, ...] | None = None
        for batch in batches:  # sorted by group; the last group may go on in the next batch
            now = tuple(batch.column(c).to_numpy() for c in ("group", "print"))
            if kept is not None:
                now = tuple(np.concatenate(x) for x in zip(kept, now, strict=True))
            if not len(now[0]):
                continue
            cut = int(np.searchsorted(now[0], now[0][-1]))
            kept = tuple(x[cut:] for x in now)
            if cut:
                yield links(now[0][:cut], now[1][:cut].view(np.uint64))
        if kept is not None:
            yield links(kept[0], kept[1].view(np.uint64))

    return run


def link(
    prints: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK, scratch: Scratch | None = None
) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within `max_bits` (4 at most) bits of each
    other. prints: print, each once; they are the nodes of the edges.

    Per group of fingerprints that are compared, the edges are a spanning forest, so thousands
    of near copies make thousands of edges, not millions.
    """
    if max_bits > 4:
        raise ValueError("cells find differences of up to 4 bits")
    entries = prints.select("print").mapInArrow(_enter, "cell bigint, print bigint")
    crowded = (
        entries.groupBy("cell").agg(F.count("*").alias("n")).filter(F.col("n") > block)
        .select("cell", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    # A cell that does not exist: the plan is the same with and without crowded cells.
    none = prints.sparkSession.range(1).select(F.lit(-1).cast("bigint").alias("cell"), F.lit(1).alias("blocks"))
    # Written, so that its size is known: all entries are shuffled for it only if it is large.
    crowded = (scratch or Scratch(prints.sparkSession)).table(crowded.unionByName(none), "crowded")
    own = F.pmod(F.xxhash64("print"), F.coalesce("blocks", F.lit(1))).cast("int")
    others = F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)
    dealt = (
        entries.join(crowded, "cell", "left")
        .withColumn("own", own)
        .withColumn("other", F.explode(others))
        .select(
            F.when(F.col("blocks").isNull(), F.col("cell")).otherwise(
                F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other"))
            ).alias("group"),
            "print",
        )
    )
    return (
        dealt.repartition("group")
        .sortWithinPartitions("group")
        .mapInArrow(_compare(max_bits), "a bigint, b bigint")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per row of `docs`: doc_id, print, component_id (the smallest doc_id reachable
    over links of at most `max_bits` differing bits, itself included).

    Null text is empty; all texts without words share the fingerprint zero. Rows are linked by
    their fingerprints alone, so a row with a null doc_id links others as any row does; it gets
    the id of its component, or null where no row of the component has one. Rows with equal
    doc_id and different texts are each in the component of their own fingerprint.
    """
    rows = scratch.table(fingerprints(docs, shingle), "prints")
    return classified(rows, scratch, max_bits).select("doc_id", "print", "component_id")


def classified(rows: DataFrame, scratch: Scratch, max_bits: int = MAX_BITS) -> DataFrame:
    """`rows` (a written table of doc_id, print and others) with component_id."""
    prints = rows.groupBy("print").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    prints = scratch.table(prints, "distinct-prints")
    found = components(link(prints, max_bits, scratch=scratch), scratch).withColumnRenamed("node", "print")
    named = prints.join(found, "print", "left").withColumn("component", F.coalesce("component", "print"))
    firsts = named.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n"))
    firsts = scratch.table(firsts, "components")
    own = salted_join(
        named.select("print", "component"), firsts.drop("n"), ["component"], heavy_keys(firsts, ["component"]),
        F.xxhash64("print"),
    ).select("print", "component_id")
    return salted_join(rows, own, ["print"], heavy_keys(prints, ["print"]), F.xxhash64("doc_id"))


def keep_one(
    docs: DataFrame, scratch: Scratch, shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of `docs`, with all their columns, that have the smallest doc_id of their
    component. Rows with a null doc_id stay, as they are no document's copy; of rows with equal
    doc_id each stays or goes by its own text."""
    docs, back = set_aside(docs)
    keyed = docs.withColumn("text_key", F.xxhash64(plain_text("text")))
    rows = keyed.select("doc_id", "text_key", "text").mapInArrow(
        _fingerprints(shingle, "text_key"), "doc_id bigint, text_key bigint, print bigint"
    )
    found = classified(scratch.table(rows, "prints"), scratch, max_bits)
    copies = found.filter("doc_id <> component_id").select("doc_id", "text_key").distinct()
    return back(keyed.join(scratch.table(copies, "copies"), ["doc_id", "text_key"], "left_anti"))
