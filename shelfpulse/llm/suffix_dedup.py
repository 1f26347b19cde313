"""Removal of long byte strings that an earlier document holds, by names of winnowed suffixes.

One suffix per run of windows is kept, chosen by content, so that every window contains one and
equal windows contain the same one. Byte strings have 64-bit names: names of depth 2d are paired
from those of depth d at the suffix and d bytes later, and each level reuses the one before (8, 16,
24, 32, then 50 from two overlapping ones of 32). A name is no rank, so a task names the suffixes
of its own texts alone and all tasks agree; only strings that are still shared meet in Spark:

1. names of depth 24 at the chosen suffixes. Those of one document are finished;
2. shared ones are compared by the names of the whole reach of their run;
3. what is left open is compared by the names of depth 50 of every window.

Two different strings are taken for one only if both names, that of the suffix and that of the
longer string, agree.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from shelfpulse.llm.common import Scratch
from shelfpulse.llm.naming import anchored, eight_bytes, mix, pair
from shelfpulse.llm.repeats import Unit, covered, remove, stretches

WINDOW = 50
DEPTH = 24
#: Passes of the two largest shuffles, where they are large: two halve the disk they need.
PASSES = 2


def refine(data: np.ndarray, wanted: int) -> tuple[np.ndarray, int]:
    """Bucket identifiers of every suffix at the greatest depth that is `wanted` halved some times
    and rounded down to a power of two, and that depth. Suffixes shorter than it have none."""
    if wanted >= 8:  # eight bytes fit into one number
        level, depth = mix(eight_bytes(data)[: max(len(data) - 7, 0)]), 8
    else:
        level, depth = mix(data.astype(np.uint64)), 1
    while depth * 2 <= wanted:
        level = pair(level[:-depth], level[depth:])
        depth *= 2
    return level, depth


def deepen(level: np.ndarray, depth: int, wanted: int, at: np.ndarray | None = None) -> np.ndarray:
    """Identifiers of depth `wanted` from those of `depth`, a power of two that is not greater: of
    all suffixes that are long enough, or of those at some positions only."""
    top = depth
    while top * 2 <= wanted:
        top *= 2
    later = wanted - top or (top // 2 if top > depth else 0)
    if not later:
        return level if at is None else level[at]
    half = top if wanted > top else later
    if at is None:
        below = deepen(level, depth, half)
        return pair(below[:-later], below[later:])
    return pair(deepen(level, depth, half, at), deepen(level, depth, half, at + later))


def _unit(window: int, depth: int) -> Unit:
    def anchors(data, begins):
        level, have = refine(data, depth)
        buckets = deepen(level, have, depth)
        return level, have, buckets, *anchored(buckets, begins, depth, window)

    def seeds(data, begins):
        if len(data) < window:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        _, _, buckets, text, anchor, _, _ = anchors(data, begins)
        return text, buckets[anchor]

    def runs(data, begins):
        if len(data) < window:
            none = np.zeros(0, dtype=np.int64)
            return none, none.view(np.uint64), none.view(np.uint64), none, none
        level, have, buckets, text, anchor, first, last = anchors(data, begins)
        # First and last window overlap or meet, so together they cover the reach.
        inside = (last - first) * (window + 1) + (anchor - first)
        ends = (deepen(level, have, window, at) for at in (first, last))
        reach = pair(pair(*ends), inside.astype(np.uint64))
        return text, buckets[anchor], reach, first - begins[text], last - begins[text]

    def names(data, begins, text, positions):
        if not len(positions):
            return np.zeros(0, dtype=np.uint64)
        return deepen(*refine(data, depth), window, begins[text] + positions)

    def cut(text, first, last):
        if not len(first):
            return text, len(text), 0, 0
        data = np.frombuffer(text, dtype=np.uint8)
        gone = covered(len(data), first, last, window)
        return data[~gone].tobytes(), len(data), int(gone.sum()), len(stretches(gone)[0])

    return Unit(window, seeds, runs, names, cut, binary=True, passes=PASSES)


def remove_repeats(
    docs: DataFrame, scratch: Scratch, window: int = WINDOW, depth: int = DEPTH
) -> DataFrame:
    """`docs` without every byte covered by a string of `window` bytes that also starts in a
    document with a smaller doc_id. Text comes back as binary, since a cut may fall inside a
    character. Adds n_units (bytes), n_removed and n_spans; other columns stay. See `repeats.remove` for nulls and equal ids."""
    return remove(docs, _unit(window, depth), scratch)
