"""Joins in which many rows of the large side match nothing and so need no shuffle.

The keys of the small side are hashed into bits, two in one 64-bit number each. The numbers are few
enough to reach every task, also where the keys are not, and tell most rows that match nothing.
Keys share bits, so a row that is let through still has to be joined; one that is held back matches
nothing for certain.
The number of bits follows the number of keys up to a bound. Beyond it they fill up and let more
rows through, at worst all of them: the result is the same, and the shuffle that of a plain join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.common import Scratch

#: Bits per key, of which each key sets two.
BITS = 16
#: At most so many numbers of 64 bits: 16 MB with their places.
MOST = 1 << 20

_PLACE, _MASK, _MAYBE = "_sieve_place", "_sieve_mask", "_sieve_maybe"


class Sieve:
    """What is known of the keys of `held`, a written table. Null keys match nothing."""

    def __init__(self, held: DataFrame, keys: list[str], scratch: Scratch, most: int = MOST):
        # Hashes depend on the type.
        self.keys = [F.col(name).cast(held.schema[name].dataType) for name in keys]
        self.held = held.count()
        wanted = -(-self.held * BITS // 64)
        self.size = min(most, 1 << max(wanted - 1, 0).bit_length())
        held = held.dropna(subset=keys).select(self._place(), self._bits().alias(_MASK))
        masks = held.groupBy(_PLACE).agg(F.bit_or(_MASK).alias(_MASK))
        self.masks = scratch.table(masks, "sieve")

    def let_through(self) -> float:
        """About what share of the rows that match nothing passes, were all bits set at random."""
        return (1 - math.exp(-2 * self.held / (64 * self.size))) ** 2

    def _hash(self) -> Column:
        return F.xxhash64(*self.keys)

    def _place(self) -> Column:
        return F.pmod(F.shiftright(self._hash(), 12), F.lit(self.size)).alias(_PLACE)

    def _bits(self) -> Column:
        one = F.lit(1).cast("bigint")
        low, high = (F.shiftright(self._hash(), n).bitwiseAND(F.lit(63)).cast("int") for n in (0, 6))
        return F.call_function("shiftleft", one, low).bitwiseOR(F.call_function("shiftleft", one, high))

    def _told(self, rows: DataFrame) -> DataFrame:
        known = rows.withColumn(_PLACE, self._place()).join(F.broadcast(self.masks), _PLACE, "left")
        maybe = F.coalesce(F.col(_MASK).bitwiseAND(self._bits()) == self._bits(), F.lit(False))
        return known.withColumn(_MAYBE, maybe)

    def passed(self, rows: DataFrame) -> DataFrame:
        """All `rows` that match, and few others."""
        return self._told(rows).filter(_MAYBE).select(rows.columns)

    def left_join(self, rows: DataFrame, few: DataFrame, on: Column) -> DataFrame:
        """`rows` left-joined with `few`, whose columns have other names. `on` holds only for equal keys."""
        own = [F.col(n) for n in rows.columns]
        told = self._told(rows).select(*own, _MAYBE)
        found = told.filter(_MAYBE).drop(_MAYBE).join(few, on, "left")
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in few.schema]
        return found.unionByName(told.filter(~F.col(_MAYBE)).select(*own, *none))
