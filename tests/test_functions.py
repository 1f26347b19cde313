from __future__ import annotations

import math
from datetime import date

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfpulse import functions as fn


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize("value", [0.575, 0.125, 2.675, -0.575, 1.005, 0.0, 123.455])
def test_rounding_is_that_of_numpy(spark, value):
    assert one(spark, r=fn.np_round(F.lit(value), 2)).r == float(np.round(value, 2))


def test_rounding_of_many_values(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.floats(-1e6, 1e6), min_size=50, max_size=50))
    def check(values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
        found = {r.i: r.r for r in df.select("i", fn.np_round(F.col("v"), 2).alias("r")).collect()}
        assert found == {i: float(np.round(v, 2)) for i, v in enumerate(values)}

    check()


def test_division_by_zero(spark):
    row = one(
        spark,
        up=fn.pdiv(F.lit(2.0), F.lit(0.0)),
        down=fn.pdiv(F.lit(-2.0), F.lit(0.0)),
        none=fn.pdiv(F.lit(0.0), F.lit(0.0)),
        missing=fn.pdiv(F.lit(1.0), F.lit(None).cast("double")),
        plain=fn.pdiv(F.lit(3.0), F.lit(4.0)),
    )
    assert (row.up, row.down, row.none, row.missing, row.plain) == (
        math.inf,
        -math.inf,
        None,
        None,
        0.75,
    )


def test_not_in_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    kept = df.filter(fn.not_in_keep_null(F.col("c"), ["a"])).collect()
    assert {r.c for r in kept} == {"b", None}
    assert df.filter(fn.not_in_keep_null(F.col("c"), [])).count() == 3


def test_shifted_epochs(spark):
    # 2001-07-31 09:59:59 and 10:00:00, fourteen hours before and at the turn of the day.
    first = 996573599
    row = one(
        spark,
        before=fn.day_from_epoch(F.lit(first), 14),
        after=fn.day_from_epoch(F.lit(first + 1), 14),
        old=fn.day_from_epoch(F.lit(-1), 0),
    )
    assert (row.before, row.after, row.old) == (
        date(2001, 7, 31),
        date(2001, 8, 1),
        date(1969, 12, 31),
    )
    assert fn.epoch_of(date(2001, 8, 1), 14) == first + 1


def test_one_line(spark):
    row = one(spark, t=fn.one_line(F.lit("a\r\nb\rc\nd\n\re")), n=fn.one_line(F.lit(None)))
    assert row.t == "a b c d  e" and row.n is None


def test_month_index(spark):
    row = one(spark, m=fn.month_index(F.lit(date(2001, 1, 31)), F.lit(date(1999, 11, 1))))
    assert row.m == 14


def test_mean_does_not_depend_on_order(spark):
    values = [(i, v) for i, v in enumerate([0.1, 0.2, 0.3, 1e6, -1e6, 0.7] * 50)]
    df = spark.createDataFrame(values, "i int, v double")
    means = {
        part.agg(fn.steady_mean(F.col("v")).alias("m")).first().m
        for part in (df, df.orderBy(F.desc("v")).coalesce(1), df.repartition(7, "v"))
    }
    assert len(means) == 1


def test_mean_keeps_every_value(spark):
    def mean(*values):
        frame = spark.createDataFrame([(v,) for v in values], "v double")
        return frame.agg(fn.steady_mean(F.col("v")).alias("m")).first().m

    assert mean(1.0, None, 3.0) == 2.0
    assert mean(1.0, 3.0, math.inf) == math.inf
    assert mean(math.inf, -math.inf) is None and mean(None) is None and mean() is None
    assert mean(1e19, 3e19) == 2e19
    assert mean(1e-10, 3e-10) == 2e-10
    assert mean(1.0, 3.0, 1e19, 1e-10) == (1e19 + 4) / 4
