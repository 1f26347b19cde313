"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is heavy with one in so many rows; so there are at most so many heavy keys.
SHARE = 256
#: ... but not below so many rows, which one task takes with ease.
LEAST = 2048
#: Tasks over which the rows of a heavy key are dealt.
SALTS = 64

_SALT = "_salt"


def heavy_keys(counts: DataFrame, keys: list[str]) -> list[int]:
    """Hashes of the keys that hold at least one in `SHARE` of all rows: at most `SHARE` numbers.

    counts: a written table of the keys and `n`, their number of rows."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    heavy = counts.filter(F.col("n") >= max(LEAST, -(-total // SHARE)))
    return [row.hash for row in heavy.select(F.xxhash64(*keys).alias("hash")).collect()]


def salted_join(
    many: DataFrame, few: DataFrame, keys: list[str], heavy: list[int], deal: Column, how: str = "inner"
) -> DataFrame:
    """`many` joined with `few` on `keys`, where `many` may hold a large share of its rows under
    the keys with a hash in `heavy`: those rows are dealt over `SALTS` copies of the key by
    `deal`, a hash of the row. how: inner, left or left_semi. Null keys match nothing.

    Both sides tell heavy keys by the same hash, so a key that is taken for heavy by chance is
    joined as right as any. The plan is the same whether there are heavy keys or not."""
    is_heavy = F.xxhash64(*keys).isin(heavy or [0])
    # Never null, or the join would first filter by it and so work out the keys twice.
    dealt = F.coalesce(F.pmod(deal, F.lit(SALTS)).cast("int"), F.lit(0))
    salt = F.when(is_heavy, dealt).otherwise(0)
    every = F.when(is_heavy, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = few.withColumn(_SALT, F.explode(every))
    return many.withColumn(_SALT, salt).join(copied, [*keys, _SALT], how).drop(_SALT)
