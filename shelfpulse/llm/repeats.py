"""Windows of a fixed length that an earlier document holds as well, found without pairs.

Both substring operators share this part. They differ in their unit (words or bytes) and in how
they name stretches of text; see their modules.

A document is cut into runs: neighbouring windows with the same anchor (see `naming.anchored`).
Equal windows have equal anchors at equal offsets, so a window can only repeat where its anchor
does. That is used in three steps, each on what the one before left open:

1. anchors that occur in one document only are finished;
2. runs equal in their whole reach: all but those of the smallest doc_id repeat;
3. what is left is one run per distinct reach of a shared anchor; its windows are compared.

Every step groups by a name and keeps a minimum, which Spark combines before the shuffle, and
joins the minimum back, which Spark splits where one name holds many rows. A group of any size
costs one row per member; no pair of members is ever formed. In step 3 a run is one row with the
names of its windows, and the few runs of an anchor are sorted by name at once; only where an
anchor has many (`CROWDED`) every window becomes a row that is grouped and joined as above.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.common import Scratch, set_aside, text_parts
from shelfpulse.llm.naming import ramp
from shelfpulse.llm.sieve import Sieve
from shelfpulse.llm.skew import heavy_keys, salted_join

RUNS = "doc_id bigint, text_key bigint, anchor bigint, reach bigint, place bigint"
_RUN_FIELDS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("anchor", pa.int64()),
        ("reach", pa.int64()),
        ("place", pa.int64()),
    ]
)
#: A place is the first window of a run and how many follow, packed to keep shuffled rows short.
_BITS = 16
_SEEDS = "doc_id bigint, anchor bigint"
_OPEN = "doc_id bigint, text_key bigint, anchor bigint, crowded boolean, place bigint, names array<bigint>"
_PLACES = "doc_id bigint, text_key bigint, place bigint"
#: Anchors with more runs than this are compared window by window, as rows.
CROWDED = 1 << 13
#: Share of the runs in one document that a sieve may let through; if more pass, all are joined.
FEW = 0.1
#: Bytes of text named at once: few enough that the arrays stay in a core's cache.
_PART = 1 << 16
#: Columns that `remove` adds; input columns of these names are replaced.
ADDED = ("n_units", "n_removed", "n_spans")
_KEY, _FOUND = "_text_key", "_repeats"


@dataclass(frozen=True)
class Unit:
    """What a window is made of.

    seeds(data, begins): per run its text and the name of its anchor.
    runs(data, begins): per run its text, the names of anchor and reach, first and last window.
    names(data, begins, text, positions): the names of windows.
    remove(text bytes, first, last): the kept bytes, units, removed units, removed stretches.
    binary: whether kept text is bytes that need not be valid UTF-8.
    passes: how many times the two largest shuffles are done, each with another part of the names;
    a name is in one part, so only disk and time change.
    """

    window: int
    seeds: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, ...]]
    runs: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, ...]]
    names: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    remove: Callable[[bytes, np.ndarray, np.ndarray], tuple[bytes, int, int, int]]
    binary: bool = False
    passes: int = 1


def _rows(doc_id, text_key, anchor, reach, place) -> pa.RecordBatch:
    columns = [doc_id, text_key, anchor.view(np.int64), reach.view(np.int64), place]
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, _RUN_FIELDS, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_RUN_FIELDS)


def _pack(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return first << _BITS | last - first


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = place >> _BITS
    return first, first + (place & (1 << _BITS) - 1)


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("doc_id").to_numpy(), batch.column(_KEY).to_numpy()


def _all_runs(unit: Unit, part: int = 0, parts: int = 1) -> Callable:
    """Runs whose anchor is in one part of the names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, key = _ids(batch)
            for low, _, data, begins in text_parts(batch, "text", _PART):
                runs = unit.runs(data, begins)
                if parts > 1:
                    own = np.flatnonzero(runs[1] % np.uint64(parts) == part)
                    runs = tuple(x[own] for x in runs)
                text, anchor, reach, first, last = runs
                if len(text):
                    place = _pack(first, last)
                    yield _rows(doc_id[low + text], key[low + text], anchor, reach, place)

    return run


def _all_anchors(unit: Unit) -> Callable:
    """Each anchor of a text and its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, _ = _ids(batch)
            for low, _, data, begins in text_parts(batch, "text", _PART):
                text, anchor = unit.seeds(data, begins)
                columns = [pa.array(doc_id[low + text]), pa.array(anchor.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "anchor"])

    return run


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, pa.StructArray]:
    """Where the list of each row begins, and all entries; a null list is empty."""
    lists = batch.column(name)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return np.concatenate(([0], np.cumsum(lengths))), lists.flatten()


def _open_windows(unit: Unit) -> Callable:
    """Each open run with the names of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, key = _ids(batch)
            begin, entries = _lists(batch, _FOUND)
            place, anchor = (entries.field(i).to_numpy() for i in range(2))
            crowded = entries.field(2)
            first, last = _unpack(place)
            for low, high, data, begins in text_parts(batch, "text", _PART):
                part = slice(begin[low], begin[high])
                counts = last[part] - first[part] + 1
                text = np.repeat(np.arange(high - low), np.diff(begin[low : high + 1]))
                names = unit.names(data, begins, np.repeat(text, counts), ramp(first[part], counts))
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                columns = [
                    *(pa.array(x) for x in (doc_id[low + text], key[low + text], anchor[part])),
                    crowded.slice(part.start, part.stop - part.start),
                    pa.array(place[part]),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(names.view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "anchor", "crowded", "place", "names"])

    return run


def _same_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring windows, as one place, that also start in a smaller document. Open runs of an
    anchor follow one another."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
        anchors = rows.column("anchor").to_numpy()
        ready = int(np.searchsorted(anchors, anchors[-1])) if len(anchors) else 0
        yield from _compared(rows.slice(0, ready))
        rest = rows.slice(ready)  # the last anchor may go on
    if rest is not None:
        yield from _compared(rest)


def _compared(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    if not rows.num_rows:
        return
    doc_id, key, anchor, place = (rows.column(n).to_numpy() for n in ("doc_id", "text_key", "anchor", "place"))
    lists = rows.column("names").combine_chunks()
    counts = pc.list_value_length(lists).to_numpy()
    names = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((names, anchor[row]))
    group, named, owner = anchor[row[order]], names[order], doc_id[row[order]]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (group[1:] != group[:-1]) | (named[1:] != named[:-1])
    begins = np.flatnonzero(new)
    least = np.minimum.reduceat(owner, begins)
    repeats = np.empty(len(order), dtype=bool)
    repeats[order] = owner > np.repeat(least, np.diff(np.append(begins, len(order))))
    # One place for neighbours in the same run.
    edge = np.ones(len(order) + 1, dtype=bool)
    edge[1:-1] = (row[1:] != row[:-1]) | (repeats[1:] != repeats[:-1])
    at = np.flatnonzero(edge)
    low, high = at[:-1], at[1:] - 1
    low, high = low[repeats[low]], high[repeats[low]]
    run = row[low]
    first, _ = _unpack(place[run])
    begin = np.cumsum(counts) - counts
    columns = [doc_id[run], key[run], _pack(first + low - begin[run], first + high - begin[run])]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "text_key", "place"])


def _removed(unit: Unit, names: list[str]) -> Callable:
    kind = pa.binary() if unit.binary else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, entries = _lists(batch, _FOUND)
            first, last = _unpack(entries.field(0).to_numpy())
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                done = [
                    unit.remove(
                        text or b"",
                        first[begin[low + i] : begin[low + i + 1]],
                        last[begin[low + i] : begin[low + i + 1]],
                    )
                    for i, text in enumerate(part.column("text").cast(pa.binary()).to_pylist())
                ]
                kept, *counts = zip(*done, strict=True)
                new = {"text": pa.array(kept, pa.binary()).cast(kind)}
                new |= {n: pa.array(c, pa.int64()) for n, c in zip(ADDED, counts, strict=True)}
                columns = [new[n] if n in new else part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _with_lists(docs: DataFrame, spans: DataFrame, fields: list[str], how: str, scratch: Scratch) -> DataFrame:
    """Each document with the list of its own spans; a list is bounded by its text. Texts without
    spans are hardly shuffled."""
    lists = spans.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct(*fields)).alias(_FOUND)
    )
    lists = lists.select(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_list_key"), _FOUND)
    lists = scratch.table(lists, "lists")
    sieve = Sieve(lists.select(F.col("_doc_id").alias("doc_id")), ["doc_id"], scratch)
    same = (F.col("doc_id") == F.col("_doc_id")) & (F.col(_KEY) == F.col("_list_key"))
    if how == "left":
        joined = sieve.left_join(docs, lists, same)
    else:
        joined = sieve.passed(docs).join(lists, same, how)
    return joined.drop("_doc_id", "_list_key")


def repeated(keyed: DataFrame, unit: Unit, scratch: Scratch) -> DataFrame:
    """Places of windows (doc_id, text_key, place) that also start in a document with a smaller
    doc_id."""
    if unit.window >> _BITS:
        raise ValueError("windows of up to 65,535 units are possible")
    texts = keyed.select("doc_id", "text", _KEY).filter("doc_id IS NOT NULL")
    holders = texts.mapInArrow(_all_anchors(unit), _SEEDS).groupBy("anchor").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")
    )
    anchors = scratch.table(holders.filter("low < high").select("anchor", "n"), "anchors")
    deal = F.xxhash64("doc_id", "place")
    sieve, parts = Sieve(anchors.select("anchor"), ["anchor"], scratch), []
    if sieve.let_through() < FEW:
        # What passes is not shuffled here. Anchors of one document among it have no smaller owner.
        passes = 1
        parts.append(scratch.table(sieve.passed(texts.mapInArrow(_all_runs(unit), RUNS)), "shared"))
    else:
        heavy, passes = heavy_keys(anchors, ["anchor"]), unit.passes
        for p in range(passes):
            runs = sieve.passed(texts.mapInArrow(_all_runs(unit, p, passes), RUNS))
            held = salted_join(runs, anchors.select("anchor"), ["anchor"], heavy, deal, "left_semi")
            parts.append(scratch.table(held, "shared"))
    shared = reduce(DataFrame.unionByName, parts)

    owners = scratch.table(
        shared.groupBy("anchor", "reach").agg(F.min("doc_id").alias("owner"), F.count("*").alias("n")), "owners"
    )
    several = owners.groupBy("anchor").agg(F.count("*").alias("n"), (F.sum("n") > CROWDED).alias("crowded"))
    several = scratch.table(several, "several")
    # Anchors whose runs have the same reach everywhere are settled here.
    open_owners = salted_join(
        owners, several.select("anchor", (F.col("n") > 1).alias("several"), "crowded"), ["anchor"],
        heavy_keys(several, ["anchor"]), F.xxhash64("reach"),
    )
    found = salted_join(shared, open_owners.drop("n"), ["anchor", "reach"], heavy_keys(owners, ["anchor", "reach"]), deal)
    found = scratch.table(
        found.select("*", (F.col("doc_id") > F.col("owner")).alias("repeats"))
        .filter("repeats OR several")
        .drop("owner", "several", "reach"),
        "found",
    )
    scratch.discard(anchors, *parts, owners, several)
    whole = found.filter("repeats").select("doc_id", "text_key", "place")

    left_open = found.filter("NOT repeats")
    listed = _with_lists(texts, left_open, ["place", "anchor", "crowded"], "inner", scratch)
    windows = scratch.table(listed.mapInArrow(_open_windows(unit), _OPEN), "windows")
    few = windows.filter("NOT crowded").repartition("anchor").sortWithinPartitions("anchor")
    spans = [scratch.table(whole, "repeated")]
    scratch.discard(found)
    spans.append(scratch.table(few.mapInArrow(_same_windows, _PLACES), "repeated"))
    for part in _parts(windows.filter("crowded"), passes):
        held = part.groupBy("anchor", "name").agg(
            F.min("doc_id").alias("owner"), F.max("doc_id").alias("high"), F.count("*").alias("n")
        )
        held = scratch.table(held.filter("owner < high").drop("high"), "held")
        same = ["anchor", "name"]
        single = salted_join(part, held.drop("n"), same, heavy_keys(held, same), deal).filter("doc_id > owner")
        spans.append(scratch.table(single.select(*whole.columns), "repeated"))
        scratch.discard(held)
    scratch.discard(windows)
    return reduce(DataFrame.unionByName, spans)


def _parts(runs: DataFrame, passes: int) -> list[DataFrame]:
    """The windows of `runs` as rows, in parts by their names."""
    rows = runs.select("doc_id", "text_key", "anchor", "place", F.posexplode("names").alias("later", "name"))
    first = F.shiftright("place", _BITS) + F.col("later")
    rows = rows.select("doc_id", "text_key", "anchor", "name", F.shiftleft(first, _BITS).alias("place"))
    if passes == 1:
        return [rows]
    return [rows.filter(F.pmod(F.col("name"), F.lit(passes)) == p) for p in range(passes)]


def remove(docs: DataFrame, unit: Unit, scratch: Scratch) -> DataFrame:
    """`docs` without the units that repeated windows cover, and with the columns `ADDED`.

    Rows with equal doc_id do not count as earlier than each other, nor does a null doc_id
    count at all: such a row keeps its text. Null text counts as empty and comes back empty.
    """
    docs, back = set_aside(docs, dropped=ADDED)
    # Rows are told apart by their ids, and by their texts where an id has several.
    several = docs.groupBy("doc_id").count().filter("count > 1").select("doc_id", F.lit(1).alias(_KEY))
    keyed = docs.join(scratch.table(several, "several"), "doc_id", "left")
    keyed = keyed.withColumn(_KEY, F.when(F.col(_KEY).isNull(), 0).otherwise(F.xxhash64("text")))
    spans = repeated(keyed, unit, scratch)
    names = [*docs.columns, *ADDED]
    kind = "binary" if unit.binary else "string"
    schema = ", ".join(
        f"`{n}` {kind if n == 'text' else t}"
        for n, t in [*docs.dtypes, *((n, "bigint") for n in ADDED)]
    )
    joined = _with_lists(keyed, spans, ["place"], "left", scratch).drop(_KEY)
    return back(joined.mapInArrow(_removed(unit, names), schema), *ADDED)


def covered(n: int, first: np.ndarray, last: np.ndarray, window: int) -> np.ndarray:
    """Which of n units a span covers whose windows start at first..last."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, last + window, -1)
    return np.cumsum(steps[:n]) > 0


def stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the maximal runs of true entries."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edges[::2], edges[1::2]
