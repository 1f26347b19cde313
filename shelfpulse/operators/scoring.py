"""Grades, scores and the benchmark row."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.functions import np_round, steady_mean

ITEM, BENCHMARK = "item", "benchmark"
SLICES = range(10, 1, -1)


def grade_cuts(df: DataFrame, metrics: Sequence[str]) -> dict[str, list[float | None]]:
    """The nine upper bounds of grades 1 to 9 for each metric, ascending.

    Every cut is taken from the values below the one before: their maximum less the n-th
    part of their range, n from 10 down to 2. Each step therefore needs one number per
    metric, the largest value below the last cut, and all metrics share its aggregate. Only
    that one row reaches the driver. Pass a staged frame, as it is read once per step.

    When no value is left below a cut, it and all later cuts are None.
    """
    row = df.agg(
        *[F.min(m).alias(f"low_{m}") for m in metrics], *[F.max(m).alias(m) for m in metrics]
    ).first()
    low = {m: row[f"low_{m}"] for m in metrics}
    top = {m: row[m] for m in metrics}
    cuts: dict[str, list[float | None]] = {m: [] for m in metrics}
    for n in SLICES:
        for m in metrics:
            cuts[m].append(_cut(low[m], top[m], n))
        if n > SLICES[-1]:
            below = [
                F.max(F.when(F.col(m) < F.lit(cuts[m][-1]).cast("double"), F.col(m))).alias(m)
                for m in metrics
            ]
            top = df.agg(*below).first().asDict()
    return {m: values[::-1] for m, values in cuts.items()}


def _cut(low: float | None, top: float | None, n: int) -> float | None:
    if low is None or top is None:
        return None
    cut = float(top) - (float(top) - float(low)) / n
    return None if math.isnan(cut) else cut


def grade(value: Column, cuts: Sequence[float | None], reverse: bool = False) -> Column:
    """Grade 1 to 10: the first range that holds the value, both of whose bounds exist.

    A value next to a missing cut gets 10, as does a missing value.
    """
    result = None
    lower = None
    for number, upper in enumerate(cuts, start=1):
        known = upper is not None and (number == 1 or lower is not None)
        if known:
            inside = value <= upper if number == 1 else (value > lower) & (value <= upper)
            result = F.when(inside, number) if result is None else result.when(inside, number)
        lower = upper
    result = F.lit(10) if result is None else result.otherwise(10)
    return ((11 - result) if reverse else result).cast("double")


def add_grades(
    df: DataFrame,
    metrics: Sequence[str],
    *,
    cuts: Mapping[str, Sequence[float | None]] | None = None,
    weights: Mapping[str, float] | None = None,
    reverse: Sequence[str] = ("oos_rate",),
) -> DataFrame:
    """A `<metric>_grade` column for each metric, times its weight."""
    cuts = cuts or grade_cuts(df, metrics)
    weights = weights or {}
    columns = {
        f"{m}_grade": grade(F.col(m), cuts[m], m in reverse) * float(weights.get(m, 1.0))
        for m in metrics
    }
    return df.withColumns(columns)


def final_score(
    df: DataFrame, metrics: Sequence[str], penalties: Mapping[str, float] | None = None
) -> DataFrame:
    """Sum of the grades less the penalty columns times their factors."""
    score = F.lit(0.0)
    for m in metrics:
        score = score + F.coalesce(F.col(f"{m}_grade"), F.lit(0.0))
    for column, factor in (penalties or {}).items():
        score = score - F.col(column) * float(factor)
    return df.withColumn("score", score)


def with_benchmark(items: DataFrame, mean_columns: Sequence[str]) -> DataFrame:
    """The items and, as a row of kind 'benchmark', the two-digit means of numeric columns."""
    items = items.withColumns({c: F.col(c).cast("double") for c in mean_columns})
    means = items.agg(*[np_round(steady_mean(F.col(c)), 2).alias(c) for c in mean_columns])
    listed = means.withColumn("row_kind", F.lit(BENCHMARK)).unionByName(
        items.withColumn("row_kind", F.lit(ITEM)), allowMissingColumns=True
    )
    return listed.select("row_kind", *items.columns)
