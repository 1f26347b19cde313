"""64-bit names of substrings, for whole arrays at once."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Longer words are named one by one.
_LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of two names in this order."""
    return mix(a * _ODD + (b ^ (b >> np.uint64(32))))


class Spans:
    """Names of spans of a sequence of 64-bit values. Names of 2^k values are paired from those of
    2^(k-1), and a span is the two names that cover it, with its length."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]

    def _level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            top, half = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(pair(top[:-half], top[half:]))
        return self.levels[k]

    def all_of(self, length: int) -> np.ndarray:
        """The span of that length at every position that has one."""
        k = length.bit_length() - 1
        level, later = self._level(k), length - (1 << k)
        return mix(pair(level[: len(level) - later], level[later:]) + np.uint64(length))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = ends - starts
        names = np.zeros(len(starts), dtype=np.uint64)
        depth = np.frexp(length)[1] - 1
        for k in np.unique(depth[length > 0]):
            at = np.flatnonzero(depth == k)
            level = self._level(int(k))
            both = pair(level[starts[at]], level[ends[at] - (1 << int(k))])
            names[at] = mix(both + length[at].astype(np.uint64))
        return names


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one number, zeros behind the end."""
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Names of byte strings: of eight bytes at a time, with the length in front, or of the whole
    string where it is long."""
    length = ends - starts
    names = mix(length.astype(np.uint64) * _ODD + np.uint64(1))
    if not len(starts):
        return names
    eight = eight_bytes(data)
    left = np.flatnonzero(length <= _LONG)
    for low in range(0, _LONG, 8):
        left = left[length[left] > low]
        if not len(left):
            break
        unused = np.maximum(8 - (length[left] - low), 0).astype(np.uint64) << np.uint64(3)
        part = eight[starts[left] + low] << unused
        names[left] = pair(names[left], part)
    for i in np.flatnonzero(length > _LONG).tolist():
        names[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return names


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def ramp(lows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """low, low + 1, ... for every (low, count), one after the other."""
    total = int(counts.sum())
    shift = lows - np.concatenate(([0], np.cumsum(counts)[:-1]))
    return np.arange(total) + np.repeat(shift, counts)


def anchored(
    names: np.ndarray, begins: np.ndarray, depth: int, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing. Every full window of a text is given the least of the names of depth `depth`
    that start in it, the first of equals; the choice depends on nothing but the window.

    names: by position. begins: where texts begin, and the end. Windows of one text with the
    same anchor are neighbours and form a run. Per run: text, anchor position, first window,
    last window (positions in the whole array).
    """
    none = np.zeros(0, dtype=np.int64)
    counts = np.maximum(np.diff(begins) - window + 1, 0)
    if not counts.sum():
        return none, none, none, none
    high = np.uint64(0xFFFFFFFF00000000)
    ranks = (names & high) | np.arange(len(names), dtype=np.uint64)
    # The position that is left when the name is cut off.
    anchor = sliding_min(ranks, window - depth + 1).astype(np.uint32)
    ends = begins[:-1] + counts
    full = counts > 0
    new = np.ones(len(anchor) + 1, dtype=bool)
    np.not_equal(anchor[1:], anchor[:-1], out=new[1:-1])
    new[begins[:-1][full]] = new[ends[full]] = True
    edges = np.flatnonzero(new)
    first, last = edges[:-1], edges[1:] - 1
    text = np.searchsorted(begins, first, side="right") - 1
    own = np.flatnonzero(first < ends[text])  # the others reach over the end of their text
    first = first[own]
    return text[own], anchor[first].astype(np.int64), first, last[own]
