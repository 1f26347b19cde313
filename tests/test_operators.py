"""Operators on small hand-made rows, one trap each."""

from __future__ import annotations

import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest

from shelfpulse.operators import (
    exposure,
    feedback,
    filters,
    growth,
    prices,
    repurchase,
    sales,
    scoring,
    stock,
    trend,
)
from shelfpulse.sources import DayHistory
from shelfpulse.sources.market import on_latest

T = date(2024, 3, 31)
SALES = (
    "product_id bigint, user_id bigint, purchased_at timestamp, product_qty double, "
    "barcode string, variant_name string, product_name string, category_m string, category_s string"
)
STOCK = "barcode string, amount bigint, recorded_at timestamp, day date"


def ago(days):
    return T - timedelta(days=days)


def sold(spark, *rows):
    """Rows of product, user, day, quantity and optionally barcode, variant and name."""
    full = []
    for product, user, day, qty, *rest in rows:
        barcode, variant, name = [*rest, *["b", "v", f"name {product}"][len(rest) :]]
        moment = datetime(day.year, day.month, day.day, 12)
        full.append((product, user, moment, qty, barcode, variant, name, "c", "s"))
    return spark.createDataFrame(full, SALES)


def options_of(spark, *rows):
    return sales.option_days(sold(spark, *rows))


def daily_of(spark, *rows):
    return spark.createDataFrame(
        [(p, d, float(q)) for p, d, q in rows], "product_id bigint, day date, qty double"
    )


def stocked(spark, *rows):
    full = [(b, a, datetime(d.year, d.month, d.day), d) for b, d, a in rows]
    return spark.createDataFrame(full, STOCK)


def by_product(df):
    return {r.product_id: r for r in df.collect()}


def test_rollup_keeps_missing_barcodes_and_quantities(spark):
    rolled = options_of(
        spark, (1, 1, ago(0), 2.0, None, "v"), (1, 2, ago(0), None, None, "v"), (1, 3, ago(0), 3.0)
    )
    assert sorted((r.barcode or "", r.qty) for r in rolled.collect()) == [("", 2.0), ("b", 3.0)]
    assert by_product(sales.daily_sales(rolled))[1].qty == 5.0


def test_last_known_takes_the_newest_even_if_null(spark):
    rolled = options_of(
        spark,
        (1, 1, ago(9), 1.0, "b", "v", "old"),
        (1, 1, ago(2), 1.0, "b", "v", "new"),
        (2, 1, ago(2), 1.0, "b", "v", "old"),
        (2, 1, ago(1), 1.0, "b", "v", None),
    )
    assert {p: r.product_name for p, r in by_product(sales.last_known(rolled, ["product_name"])).items()} == {
        1: "new",
        2: None,
    }
    earlier = sales.last_known(rolled, ["product_name"], ago(5))
    assert by_product(earlier)[1].product_name == "old"


def test_substitutes_keep_ties_and_the_unsold(spark):
    lines = sold(spark, (20, 1, ago(5), 3.0), (21, 1, ago(5), 5.0), (22, 1, ago(200), 99.0))
    losers = sales.substitute_losers(sales.option_days(lines), (20, 21, 22), T)
    assert [r.product_id for r in losers.collect()] == [20]
    tied = sold(spark, (20, 1, ago(5), 5.0), (21, 1, ago(90), 5.0))
    assert sales.substitute_losers(sales.option_days(tied), (20, 21), T).count() == 0


def test_weekly_growth_windows(spark):
    daily = daily_of(
        spark,
        (1, ago(0), 8),  # recent
        (1, ago(7), 4),  # in both windows
        (1, ago(35), 10),  # first day of the earlier window
        (1, ago(36), 1000),  # outside
        (2, ago(1), 6),  # not above the threshold, no stock: drops out
        (3, ago(1), 6),  # not above the threshold, in stock: zeros
        (4, ago(3), 7),  # new: the base is 1
    )
    held = spark.createDataFrame(
        [(1, ago(1)), (1, ago(0)), (3, ago(1)), (3, ago(2)), (3, ago(50)), (1, ago(20))],
        "product_id bigint, day date",
    )
    found = by_product(growth.weekly_growth(daily, held, T))
    assert set(found) == {1, 3, 4}
    # Two days sold and one in stock unsold; earlier two days sold and one unsold.
    assert (found[1].last_avg_qty, found[1].past_avg_qty) == (4.0, 4.67)
    assert found[1].growth_rate == 0.86
    assert (found[3].last_avg_qty, found[3].past_avg_qty, found[3].growth_rate) == (0.0, 1.0, 0.0)
    assert (found[4].last_avg_qty, found[4].past_avg_qty) == (7.0, 1.0)
    high = growth.weekly_growth(daily, held, T, atleast_avg_qty=5)
    assert set(by_product(high)) == {4}


def test_missing_barcodes_match_each_other(spark):
    held = stocked(spark, (None, ago(1), 5), ("b", ago(2), 5), ("b", ago(3), 0), ("b", ago(4), None))
    codes = sales.barcode_map(
        options_of(spark, (1, 1, ago(0), 1.0), (2, 1, ago(0), 1.0, None), (3, 1, ago(0), 1.0, "c"))
    )
    days = growth.stock_days(held, codes, ago(35), T).collect()
    assert {(r.product_id, r.day) for r in days} == {(1, ago(2)), (1, ago(4)), (2, ago(1))}


def test_yearly_growth(spark):
    rows = []
    for n in range(30):
        rows += [(1, ago(n), 6), (2, ago(n), 6), (3, ago(n), 6)]
    rows += [(1, ago(400), 3)]  # last year
    rows += [(2, ago(200), 4), (2, ago(170), 2), (2, ago(169), 100)]  # first 31 days: 4 and 2
    rows += [(3, ago(179), 4)]  # not on sale long enough
    rows += [(4, ago(n), 6) for n in range(29)]  # too few days
    found = by_product(growth.yearly_growth(daily_of(spark, *rows), T))
    assert set(found) == {1, 2, 3}
    assert found[1].yoy_rate == 2.0
    assert found[2].last_year_qty == 3.0
    assert found[3].yoy_rate == 0.0


def test_period_bounds_clamp_to_the_month_end(spark):
    leap = date(2024, 2, 29)
    rows = [(1, leap - timedelta(days=n), 1) for n in range(30)]
    rows += [(1, date(2023, 2, 28), 5)]  # the first day of the range is left out of this year
    assert by_product(growth.yearly_growth(daily_of(spark, *rows), leap))[1].last_year_qty == 5.0


def test_quarterly_growth_by_zero_and_by_nothing(spark):
    rows = [(p, ago(n), 2) for p in (1, 2) for n in range(20)] + [(1, ago(100), 0)]
    found = by_product(growth.quarterly_growth(daily_of(spark, *rows), T))
    assert found[1].qoq_rate == math.inf
    assert found[2].qoq_rate == 0.0


def test_repurchases(spark):
    lines = sold(
        spark,
        *[(1, 7, ago(n), 1.0) for n in (0, 1, 2, 90)],
        (1, 7, ago(91), 1.0),  # in the long period only
        (1, 8, ago(0), 1.0),
        (1, None, ago(0), 1.0),  # no customer
        (2, 8, ago(0), 1.0),
    )
    totals = repurchase.purchase_totals(repurchase.purchase_counts(lines, T, [90, 180]), [90, 180])
    short = by_product(repurchase.repurchase_rate(totals, 90))
    assert (short[1].purchase_count, short[1].repurchase_count, short[1].repurchase_rate) == (5, 3, 0.6)
    assert short[2].repurchase_count == 0
    assert by_product(repurchase.repurchase_rate(totals, 180))[1].purchase_count == 6
    broad = by_product(repurchase.repurchase_breadth(totals, 90, min_orders=3, min_users=1))
    assert (broad[1].repurchase_users, broad[1].repurchase_user_rate) == (1, 0.33)
    index = by_product(repurchase.repurchase_index(totals, 90, min_orders=0, min_users=0))
    assert index[1].repurchase_index == 0.6 * 0.33 and set(index) == {1}


def test_top_two_options(spark):
    lines = [
        (1, 1, ago(0), 6.0, "10", "a"),
        (1, 1, ago(1), 2.0, "11", "b"),
        (1, 1, ago(99), 5.0, "12", "c"),  # sold before the window: no share, supply over 1
        (2, 1, ago(0), 4.0, "20", "a"),  # a single option
        (3, 1, ago(99), 4.0, "30", "a"),  # never sold in the window
        (4, 1, ago(0), 4.0, None, "a"),  # no barcode
        (5, 1, ago(0), 4.0, "50", "a"),  # no stock on the newest day
        (6, 1, ago(0), 3.0, "60", "a"),  # moved to product 2
    ]
    held = stocked(
        spark,
        *[(b, ago(0), 12) for b in ("10", "11", "12", "20", "30", None, "60")],
        ("50", ago(1), 12),
    )
    found = by_product(stock.stock_turnover(on_latest(held, "day"), options_of(spark, *lines), T))
    assert set(found) == {1, 2, 3, 6}
    assert (found[1].opt1_barcode, found[1].opt1_share, found[1].opt1_dsi) == ("10", 0.75, 2.0)
    assert (found[1].opt2_barcode, found[1].opt2_share, found[1].opt2_dsi) == ("11", 0.25, 6.0)
    assert (found[2].opt1_share, found[2].opt2_barcode, found[2].opt2_dsi) == (1.0, None, 0.0)
    assert (found[3].opt1_share, found[3].opt1_dsi) == (None, 12.0)
    moved = by_product(stock.stock_turnover(on_latest(held, "day"), options_of(spark, *lines), T, alias=[(6, 2)]))
    assert 6 not in moved and moved[2].opt2_barcode == "60" and moved[2].opt2_share == 1.0


def test_equal_shares_resolve_by_barcode(spark):
    lines = [(1, 1, ago(0), 2.0, code, "v") for code in ("9", "8", "7")]
    held = stocked(spark, *[(code, ago(0), 1) for code in ("9", "8", "7")])
    found = by_product(stock.stock_turnover(on_latest(held, "day"), options_of(spark, *lines), T))
    assert (found[1].opt1_barcode, found[1].opt2_barcode) == ("7", "8")


def test_out_of_stock_rate(spark):
    held = stocked(
        spark,
        ("a", ago(6), 0), ("b", ago(6), 0),  # nothing of either
        ("a", ago(5), 0), ("b", ago(5), 2),  # the other option is there
        ("a", ago(4), None),  # unknown counts as nothing
        ("a", ago(7), 0),  # before the window
    )
    codes = sales.barcode_map(options_of(spark, (1, 1, T, 1.0, "a"), (1, 1, T, 1.0, "b")))
    row = by_product(stock.out_of_stock_rate(held, codes, T))[1]
    assert (row.tracked_days, row.oos_days, row.oos_rate) == (3, 2, 2 / 3)


def test_any_in_stock_looks_at_the_newest_record(spark):
    codes = spark.createDataFrame([("a",), ("b",)], "barcode string")
    gone = stocked(spark, ("a", ago(3), 5), ("a", ago(1), 0), ("c", ago(0), 9))
    assert stock.any_in_stock(gone, codes).first().in_stock is False
    there = stocked(spark, ("a", ago(1), 0), ("b", ago(9), 1))
    assert stock.any_in_stock(there, codes).first().in_stock is True


EXPOSED = "product_id bigint, day date, popularity double, main_rec_category string"


def test_streak_stops_at_a_gap(spark):
    rows = [(1, ago(n), 1.0, "z") for n in (0, 1, 2, 4, 5)]
    rows += [(2, ago(0), 1.0, "low"), (2, ago(0), 5.0, "high"), (2, ago(0), None, "none")]
    rows += [(3, ago(1), 9.0, "z")]  # not on the newest day
    found = by_product(exposure.exposure_streak(spark.createDataFrame(rows, EXPOSED)))
    assert set(found) == {1, 2}
    assert found[1].exposure_start == ago(2)
    assert (found[2].exposure_start, found[2].main_rec_category) == (ago(0), "high")


def test_streaks_by_steps_read_no_further_than_the_longest(spark):
    rng = np.random.default_rng(2)
    length = {p: int(n) for p, n in enumerate([1, 2, 3, 4, 5, 6, 7, 13, 14, 15, 40])}
    rows = [(p, ago(n), 1.0, "z") for p, days in length.items() for n in range(days)]
    # Behind a gap of a day, much more history; products not shown now; days seen many times.
    rows += [(p, ago(n), 2.0, "y") for p, days in length.items() for n in range(days + 1, days + 60)]
    rows += [(99, ago(n), 5.0, "x") for n in range(1, 200)] + [(None, ago(0), 1.0, "z")]
    rows += [rows[i] for i in rng.integers(0, len(rows), 300)]
    history = DayHistory(spark.createDataFrame(rows, EXPOSED))
    asked = []

    def between(first, last):
        asked.append(((T - last).days, (T - first).days))
        return history.between(first, last)

    shown = exposure.popular_zones(history.newest()).cache()
    found = by_product(exposure.streaks_by_steps(between, shown, lambda df: df.cache(), first_step=2))
    assert asked == [(0, 1), (2, 5), (6, 13), (14, 29), (30, 61)]
    assert {p: r.exposure_start for p, r in found.items()} == {p: ago(n - 1) for p, n in length.items()}
    assert found == by_product(exposure.exposure_streak(history.all()))
    empty = exposure.popular_zones(DayHistory(history.all().limit(0)).newest())
    assert exposure.streaks_by_steps(between, empty, lambda df: df).isEmpty()


def test_uplift(spark):
    streaks = spark.createDataFrame(
        [(p, "z", ago(1), T) for p in (1, 2, 3)],
        "product_id bigint, main_rec_category string, exposure_start date, latest_day date",
    )
    daily = daily_of(
        spark, (1, ago(0), 3), (1, ago(1), 3), (1, ago(2), 8), (1, ago(8), 8), (1, ago(9), 99), (2, ago(0), 5)
    )
    found = by_product(exposure.exposure_uplift(streaks, daily))
    assert found[1].exposure_uplift == 1.5  # 6 over 2 days against 16 over 8
    assert found[2].exposure_uplift == 2.5  # against 1
    assert found[3].exposure_uplift == 0.0


def test_reviews(spark):
    rows = [
        (1, 11, 5, "good", ago(0)), (1, 12, 2, "bad", ago(8)), (1, 13, 2, "worse", ago(1)),
        (1, 14, 1, "old", ago(9)), (2, 21, 4, None, ago(0)),
    ]
    frame = spark.createDataFrame(
        rows, "product_id bigint, post_id bigint, rating_value bigint, message string, post_day date"
    )
    found = by_product(feedback.review_summary(frame, T))
    assert (found[1].avg_rating, found[1].review_count, found[1].negative_reviews) == (3.0, 3, 2)
    assert (found[1].negative_case, found[1].review_length) == ("bad", 4.0)
    assert (found[2].negative_reviews, found[2].negative_case, found[2].review_length) == (0, None, None)


NAMES = ("11st", "Coupang", "Iherb", "Ople")
PRICES = "date date, competitor string, product_id bigint, krw_price double, usd_price double"


def price_frames(spark, missing=()):
    rows = [(T, n, 9, 5.0, 1.0) for n in NAMES if n not in missing]
    rows += [
        (T, "11st", 1, 30.0, 1.0), (T, "11st", 1, 20.0, 1.0), (T, "Coupang", 1, -1.0, 1.0),
        (T, "Iherb", 1, 10.0, 0.0), (T, "11st", 2, 10.0, None),
    ]
    crawls = spark.createDataFrame(
        [("11st", 2, 0), ("Ople", 2, 1)], "competitor string, product_id bigint, sale_or_not bigint"
    )
    own = spark.createDataFrame([(1, 15.0), (2, None)], "product_id bigint, price_own double")
    return own, spark.createDataFrame(rows, PRICES), crawls


def test_price_matrix(spark):
    found = by_product(prices.price_matrix(*price_frames(spark), NAMES))
    one, two = found[1], found[2]
    assert (one.price_11st, one.price_11st_status) == (20.0, "정상수집")
    assert (one.price_coupang, one.price_coupang_status) == (None, "수집오류")
    assert (one.price_iherb_status, one.price_ople_status) == ("수집오류", "미수집")
    assert (two.price_11st_status, two.price_ople_status) == ("미판매", "수집오류")
    assert two.price_own_status == "미수집"


def test_a_missing_competitor_blanks_all(spark):
    frames = price_frames(spark, missing=["Ople"])
    row = by_product(prices.price_matrix(*frames, NAMES))[1]
    assert (row.price_11st, row.price_11st_status) == (None, "수집오류")
    lenient = by_product(prices.price_matrix(*frames, NAMES, all_or_none=False))[1]
    assert lenient.price_11st == 20.0


def test_price_score(spark):
    rows = [(1, 10.0, 9.0, 9.0), (2, 10.0, None, None), (3, 10.0, 12.0, None), (4, 10.0, None, 12.0)]
    frame = spark.createDataFrame(
        [(p, own, main, other, None, None) for p, own, main, other in rows],
        "product_id bigint, price_own double, price_coupang double, price_11st double, "
        "price_iherb double, price_ople double",
    )
    found = by_product(prices.price_score(frame, NAMES))
    assert {p: r.price_score for p, r in found.items()} == {1: -3.0, 2: 4.0, 3: 2.0, 4: 1.0}


def grades(spark, values, reverse=()):
    frame = spark.createDataFrame(list(enumerate(map(float, values))), "i int, v double")
    graded = scoring.add_grades(frame, ["v"], reverse=reverse)
    return [r.v_grade for r in graded.orderBy("i").collect()]


def test_grades(spark):
    assert grades(spark, range(11)) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 10]
    assert grades(spark, range(11), reverse=["v"]) == [10, 9, 8, 7, 6, 5, 4, 3, 2, 2, 1]
    assert grades(spark, [0, 100]) == [10, 10]
    assert grades(spark, [5, 5, 5]) == [10, 10, 10]
    assert grades(spark, [1, 2, math.inf]) == [10, 10, 10]


def brute_force_grades(values):
    cuts, rest = [], list(values)
    for n in range(10, 1, -1):
        cut = max(rest) - (max(rest) - min(rest)) / n if rest else math.nan
        rest = [v for v in rest if v < cut]
        cuts.insert(0, cut)
    result = []
    for v in values:
        if v <= cuts[0]:
            result.append(1)
            continue
        hits = [n for n in range(1, 9) if cuts[n - 1] < v <= cuts[n]]
        result.append(hits[0] + 1 if hits else 10)
    return result


def test_grades_of_many_values(spark):
    values = np.round(np.random.default_rng(3).exponential(5, 400), 2)
    assert grades(spark, values) == brute_force_grades(list(values))


def test_score_and_benchmark(spark):
    frame = spark.createDataFrame(
        [(1, 2.0, 1.0), (2, 3.0, 0.0)], "product_id bigint, m_grade double, bad double"
    )
    scored = scoring.final_score(frame, ["m"], {"bad": 2})
    assert {p: r.score for p, r in by_product(scored).items()} == {1: 0.0, 2: 3.0}
    assert {p: r.score for p, r in by_product(scoring.final_score(frame, ["m"])).items()} == {1: 2.0, 2: 3.0}
    listed = {r.product_id: r for r in scoring.with_benchmark(frame, ["m_grade"]).collect()}
    assert (listed[None].row_kind, listed[None].m_grade, listed[None].bad) == ("benchmark", 2.5, None)


def test_list_filters(spark):
    frame = spark.createDataFrame(
        [
            (1, 5.0, 6.0, None, None), (2, 5.0, 5.0, "z", 1.0), (3, None, None, "z", 0.99),
            (31, 0.0, 0.0, "z", 0.0), (4, 5.0, None, "z", None),
        ],
        "product_id bigint, opt1_dsi double, opt2_dsi double, main_rec_category string, "
        "exposure_uplift double",
    )
    assert set(by_product(frame.filter(filters.turnover_ok(11, [31])))) == {1, 3, 31}
    assert set(by_product(frame.filter(filters.exposure_ok()))) == {1, 2}
    assert set(by_product(frame.filter(filters.exposure_ok([31])))) == {1, 2, 31}


def test_top_ranked_has_a_total_order(spark):
    frame = spark.createDataFrame(
        [(5, 1.0, 2.0), (4, 1.0, 2.0), (3, 1.0, 3.0), (2, 9.0, 0.0), (1, 0.0, 9.0)],
        "product_id bigint, score double, last_avg_qty double",
    )
    top = filters.top_ranked(frame, 4, filters.list_order("score")).collect()
    assert [(r.product_id, r.rank) for r in sorted(top, key=lambda r: r.rank)] == [
        (2, 1), (3, 2), (4, 3), (5, 4),
    ]


def objective(x, y, slope, level, scale):
    z = (x * slope + level - y) / scale
    bent = np.where(
        np.abs(z) <= trend.EPSILON, z**2, 2 * trend.EPSILON * np.abs(z) - trend.EPSILON**2
    )
    return (scale + scale * bent).sum() + trend.ALPHA * slope**2


def lowest(f, low, high):
    """The minimum of a convex function, by thirds."""
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if f(a) <= f(b) else (a, high)
    return f((low + high) / 2)


def best_for_slope(x, y, slope):
    """The objective at a fixed slope; it is convex, so level and scale are searched in turn."""
    errors = y - x * slope
    return lowest(
        lambda c: lowest(lambda s: objective(x, y, slope, c, s), 1e-9, 4), errors.min(), errors.max()
    )


@pytest.mark.parametrize("seed", range(4))
def test_no_other_slope_fits_better(seed):
    rng = np.random.default_rng(seed)
    x = np.arange(12.0)
    y = 0.3 + 0.02 * x + rng.normal(0, 0.05, 12)
    y[rng.integers(12)] += 0.8
    found = trend.robust_slopes(x[None], y[None], np.ones((1, 12), bool))[0]
    here = best_for_slope(x, y, found)
    for other in found + np.array([-0.05, -0.002, 0.002, 0.05]):
        assert here < best_for_slope(x, y, other)
    halved = trend.halved_slopes(x[None], y[None], np.ones((1, 12), bool))[0]
    assert halved == pytest.approx(found, abs=1e-7)


def test_every_trend_ends():
    """Points of which any number lies on a line, of all lengths; every one gets the best slope,
    those that reweighting leaves unsettled too."""
    rng = np.random.default_rng(11)
    x, y, known = [], [], []
    for n in range(2, 25):
        for on_line in range(1, n + 1):
            points = np.zeros(24)
            points[:n] = 0.5 + 0.01 * np.arange(n)
            off = rng.permutation(n)[on_line:]
            points[off] += rng.choice([1, -1, 0.5, 0.25], len(off))
            known.append(np.arange(24) < n)
            x.append(np.arange(24.0) * known[-1])
            y.append(points)
    x, y, known = np.array(x), np.array(y), np.array(known)
    found = trend.robust_slopes(x, y, known)
    assert not np.isnan(found).any()
    for rounds in (0, 3, 20_000):
        assert np.abs(trend.robust_slopes(x, y, known, rounds) - found).max() < 1e-6
    assert np.isnan(trend.robust_slopes(x[:0], y[:0], known[:0])).sum() == 0


def test_scale_solves_its_equation():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 24):
        size = np.abs(rng.normal(0, 1, (50, n))) * (rng.random((50, n)) < 0.8)
        scale = trend.best_scale(size, np.ones((50, n), bool))
        for row, s in zip(size, scale, strict=True):
            if trend.EPSILON**2 * (row > 0).sum() <= n:
                assert s == trend.TINY
            else:
                assert (np.minimum(row / s, trend.EPSILON) ** 2).sum() == pytest.approx(n)


def test_trend_of_short_straight_and_padded_series(spark):
    month = [date(2023, m, 15) for m in range(1, 13)]
    rows = [(1, month[0], 5), (1, month[1], 9)]  # too few months
    rows += [(2, d, 10 * (n + 1)) for n, d in enumerate(month[:10])]  # a straight line
    rows += [(3, month[n], 7) for n in (2, 5, 9)]  # level
    found = by_product(trend.long_term_growth(daily_of(spark, *rows)))
    assert {p: r.lt_growth for p, r in found.items()} == {1: 0.0, 2: 0.1, 3: 0.0}
