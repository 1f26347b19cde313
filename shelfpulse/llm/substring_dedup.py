"""Removal of long word sequences that an earlier document holds, by seed and extend.

Seeds are the winnowed anchors of a document: sequences of `SEED` words, chosen so that every
window of the threshold length contains one and equal windows contain the same one. Documents
are joined on seeds. A shared seed is then extended to both sides: first at once over all the
words its windows reach; where that differs between documents, word by word, as every choice of
left and right words that adds up to the threshold length. Overlapping and adjacent matches grow
together into the maximal repeats. A seed that thousands of documents share is extended once per
document and compared through the names of the extensions, never pair by pair.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from shelfpulse.llm.common import Scratch, word_bounds
from shelfpulse.llm.naming import Spans, anchored, pair, word_names
from shelfpulse.llm.repeats import Unit, covered, remove, stretches

WINDOW = 50
SEED = 10


def _unit(window: int, seed: int) -> Unit:
    def words(data, begins):
        starts, ends, begin = word_bounds(data, begins)
        return Spans(word_names(data, starts, ends)), begin

    def runs(data, begins):
        spans, begin = words(data, begins)
        seeds = spans.all_of(seed)
        text, anchor, first, last = anchored(seeds, begin, seed, window)
        # The reach: all words of the run's windows, and where in them the seed lies.
        reach = pair(spans.of(first, last + window), (anchor - first).astype(np.uint64))
        return text, seeds[anchor], reach, first - begin[text], last - begin[text]

    def names(data, begins, text, positions):
        spans, begin = words(data, begins)
        starts = begin[text] + positions
        return spans.of(starts, starts + window)

    def cut(text, first, last):
        data = np.frombuffer(text, dtype=np.uint8)
        if not len(first):
            return text, len(text.split()), 0, 0
        starts, _, _ = word_bounds(data, np.array([0, len(data)]))
        gone = covered(len(starts), first, last, window)
        low, high = stretches(gone)
        # A removed stretch takes the white space behind it along.
        edge = np.append(starts, len(data))
        keep = np.ones(len(data), dtype=bool)
        for a, b in zip(edge[low], edge[high], strict=True):
            keep[a:b] = False
        return data[keep].tobytes(), len(starts), int(gone.sum()), len(low)

    return Unit(window, lambda d, b: runs(d, b)[:2], runs, names, cut)


def remove_repeats(
    docs: DataFrame, scratch: Scratch, window: int = WINDOW, seed: int = SEED
) -> DataFrame:
    """`docs` without every word covered by a window of `window` words that also starts in a
    document with a smaller doc_id. Adds n_units (words), n_removed and n_spans; other columns
    stay. See `repeats.remove` for nulls and equal ids; documents shorter than a window stay as
    they are."""
    return remove(docs, _unit(window, seed), scratch)
