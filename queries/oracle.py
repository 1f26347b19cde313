"""The registered queries as DuckDB SQL, written separately from the Spark code.

A query text names common table expressions; `statement` puts in front of it all that it
needs, directly or through others.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from queries.views import CART_END, CART_START, VIEWS, view_text

FIRST_DAY, RUN_DAY = "DATE '1999-08-01'", "DATE '2001-08-01'"


def rd(x: str, digits: int) -> str:
    scale = f"CAST({10**digits} AS DOUBLE)"
    return f"(ROUND_EVEN(({x}) * {scale}, 0) / {scale})"


def mean(x: str) -> str:
    """The mean; a compensated sum unless a value is infinite, which it would not survive."""
    return (
        f"(CASE WHEN BOOL_OR(ISINF({x})) THEN AVG({x}) "
        f"ELSE FSUM(CAST({x} AS DOUBLE)) / COUNT({x}) END)"
    )


def mean_of_cents(x: str) -> str:
    """The mean of values that have two digits, over their exact sum."""
    return f"(CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({x}))"


def ieee(a: str, b: str) -> str:
    return (
        f"(CASE WHEN ({b}) = 0 THEN CASE WHEN ({a}) > 0 THEN CAST('inf' AS DOUBLE) "
        f"WHEN ({a}) < 0 THEN CAST('-inf' AS DOUBLE) END ELSE ({a}) / ({b}) END)"
    )


CTES: dict[str, str] = {}

# --- sales ------------------------------------------------------------------------------
CTES["hist"] = f"SELECT * FROM fx_sales WHERE purchased_at BETWEEN {FIRST_DAY} AND {RUN_DAY}"
CTES["cmpt"] = """
SELECT DISTINCT competitor, product_id, krw_price, usd_price FROM fx_cmpt
WHERE date = (SELECT MAX(date) FROM fx_cmpt)"""
CTES["lines"] = "SELECT * FROM hist WHERE category_m IS NULL OR category_m <> 'excluded'"
CTES["all_daily"] = (
    "SELECT product_id, purchased_at AS day, SUM(product_qty) AS qty FROM lines GROUP BY ALL"
)
CTES["all_top"] = "SELECT MAX(day) AS t FROM all_daily"
CTES["pin_state"] = """
SELECT COALESCE(BOOL_OR(amount > 0), FALSE) AS in_stock FROM (
 SELECT barcode, amount, ROW_NUMBER() OVER (PARTITION BY barcode ORDER BY day DESC, amount DESC) AS rn
 FROM fx_stock WHERE barcode IN (SELECT barcode FROM fx_sales WHERE product_id = 31)) WHERE rn = 1"""
CTES["opt_lines"] = "SELECT * FROM lines WHERE product_id <> 31 OR (SELECT in_stock FROM pin_state)"
CTES["losers"] = f"""
SELECT product_id FROM (
 SELECT product_id, SUM(product_qty) AS q, MAX(SUM(product_qty)) OVER () AS best FROM opt_lines
 WHERE product_id IN (20, 21) AND purchased_at >= {RUN_DAY} - INTERVAL 90 DAY GROUP BY product_id)
WHERE q <> best"""
CTES["ok_lines"] = """
SELECT l.* FROM opt_lines l LEFT JOIN fx_status s USING (product_id)
WHERE COALESCE(s.status NOT IN ('D', 'H'), TRUE) AND l.product_id <> 33
 AND l.product_id NOT IN (SELECT product_id FROM losers)"""
CTES["ok_daily"] = (
    "SELECT product_id, purchased_at AS day, SUM(product_qty) AS qty FROM ok_lines GROUP BY ALL"
)
CTES["ok_top"] = "SELECT MAX(day) AS t FROM ok_daily"


def last_known(lines: str) -> str:
    return f"""
SELECT product_id, product_name, category_m, category_s FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY purchased_at DESC,
  product_name DESC NULLS LAST, category_m DESC NULLS LAST, category_s DESC NULLS LAST) AS rn FROM {lines})
WHERE rn = 1"""


CTES["all_names"], CTES["ok_names"] = last_known("lines"), last_known("ok_lines")


def recent(daily: str, top: str) -> str:
    return f"""
SELECT product_id, {rd("AVG(qty)", 2)} AS last_avg_qty FROM {daily}, {top}
WHERE day BETWEEN t - 7 AND t GROUP BY product_id"""


CTES["all_recent"], CTES["ok_recent"] = recent("all_daily", "all_top"), recent("ok_daily", "ok_top")

# --- growth -----------------------------------------------------------------------------


def stock_left(lines: str) -> str:
    return f"""
SELECT DISTINCT b.product_id, s.day FROM fx_stock s
JOIN (SELECT DISTINCT barcode, product_id FROM {lines}) b ON s.barcode IS NOT DISTINCT FROM b.barcode
WHERE s.amount <> 0"""


CTES["all_stock_left"], CTES["opt_stock_left"] = stock_left("lines"), stock_left("opt_lines")


def weekly(daily: str, top: str, left: str) -> str:
    def window_mean(source: str, low: str, high: str) -> str:
        return f"""
SELECT product_id, AVG(qty) AS q FROM (
 SELECT COALESCE(d.product_id, s.product_id) AS product_id, COALESCE(d.day, s.day) AS day,
  COALESCE(d.qty, 0) AS qty FROM ({source}) d FULL JOIN {left} s ON d.product_id = s.product_id AND d.day = s.day), {top}
WHERE day BETWEEN {low} AND {high} GROUP BY product_id"""

    sellers = (
        f"SELECT product_id FROM {daily}, {top} WHERE day BETWEEN t - 7 AND t "
        "GROUP BY product_id HAVING SUM(qty) > 6"
    )
    latest = window_mean(
        f"SELECT product_id, day, qty FROM {daily}, {top} WHERE day BETWEEN t - 7 AND t "
        f"AND product_id IN ({sellers})",
        "t - 7",
        "t",
    )
    base = window_mean(
        f"SELECT product_id, day, qty FROM {daily}, {top} WHERE day BETWEEN t - 35 AND t - 7",
        "t - 35",
        "t - 7",
    )
    floor = "CASE WHEN b.q IS NULL OR b.q < 1 THEN CAST(1 AS DOUBLE) ELSE b.q END"
    return f"""
SELECT l.product_id, {rd("l.q", 2)} AS last_avg_qty, {rd(floor, 2)} AS past_avg_qty,
 {rd(f"l.q / ({floor})", 2)} AS growth_rate
FROM ({latest}) l LEFT JOIN ({base}) b ON l.product_id = b.product_id"""


CTES["all_weekly"] = weekly("all_daily", "all_top", "all_stock_left")
CTES["ok_weekly"] = weekly("ok_daily", "ok_top", "opt_stock_left")


def period_growth(daily: str, top: str, months: int, days: int) -> str:
    now = f"day > CAST(t - INTERVAL {months} MONTH AS DATE) AND day <= t"
    before = (
        f"day > CAST(t - INTERVAL {2 * months} MONTH AS DATE) "
        f"AND day <= CAST(t - INTERVAL {months} MONTH AS DATE)"
    )
    return f"""
SELECT n.product_id, n.q AS now_qty, b.q AS before_qty FROM
 (SELECT product_id, AVG(qty) AS q FROM {daily}, {top} WHERE {now} GROUP BY product_id HAVING COUNT(*) >= {days}) n
 LEFT JOIN (SELECT product_id, AVG(qty) AS q FROM {daily}, {top} WHERE {before} GROUP BY product_id) b
 ON n.product_id = b.product_id"""


def yoy(daily: str, top: str) -> str:
    return f"""
SELECT p.product_id, p.now_qty AS this_year_qty, COALESCE(p.before_qty, a.q) AS last_year_qty,
 COALESCE({rd(ieee("p.now_qty", "COALESCE(p.before_qty, a.q)"), 4)}, 0) AS yoy_rate
FROM ({period_growth(daily, top, 12, 30)}) p
LEFT JOIN (
 SELECT d.product_id, AVG(d.qty) AS q FROM {daily} d
 JOIN (SELECT product_id, MIN(day) AS f FROM {daily} GROUP BY product_id) f ON d.product_id = f.product_id, {top}
 WHERE d.day <= f.f + 30 AND t - f.f >= 180 GROUP BY d.product_id) a ON p.product_id = a.product_id"""


def qoq(daily: str, top: str) -> str:
    return f"""
SELECT product_id, now_qty AS this_quarter_qty, before_qty AS last_quarter_qty,
 COALESCE({rd(ieee("now_qty", "before_qty"), 4)}, 0) AS qoq_rate
FROM ({period_growth(daily, top, 3, 20)})"""


CTES["all_yoy"], CTES["ok_yoy"] = yoy("all_daily", "all_top"), yoy("ok_daily", "ok_top")
CTES["all_qoq"], CTES["ok_qoq"] = qoq("all_daily", "all_top"), qoq("ok_daily", "ok_top")


def monthly(daily: str) -> str:
    first = f"(SELECT MIN(day) FROM {daily})"
    return f"""
SELECT product_id, CAST((YEAR(day) - YEAR({first})) * 12 + MONTH(day) - MONTH({first}) AS INTEGER) AS month_num,
 SUM(qty) AS qty FROM {daily} GROUP BY ALL"""


def points(month: str) -> str:
    return f"""
SELECT product_id, CAST(month_num AS DOUBLE) AS x, qty / MAX(qty) OVER (PARTITION BY product_id) AS y,
 COUNT(*) OVER (PARTITION BY product_id) AS n FROM {month} QUALIFY n >= 3"""


def fit(pts: str, name: str) -> str:
    return f"""
SELECT DISTINCT product_id, 0 AS i, CAST(0 AS DOUBLE) AS w, CAST(0 AS DOUBLE) AS c, CAST(1 AS DOUBLE) AS s FROM {pts}
UNION ALL
SELECT product_id, i + 1, w, c, GREATEST(2.220446049250313e-15,
  CASE WHEN COUNT(*) - 1.8225 * COUNT(*) FILTER (WHERE e > 1.35 * s) > 0
   THEN SQRT(COALESCE(SUM(e * e) FILTER (WHERE e <= 1.35 * s), 0)
    / (COUNT(*) - 1.8225 * COUNT(*) FILTER (WHERE e > 1.35 * s))) ELSE s * 0.9 END)
FROM (SELECT u.product_id, i, w, (sy - w * sx) / so AS c, s, ABS(p.x * w + (sy - w * sx) / so - p.y) AS e
 FROM (SELECT *, (sxy - sx * sy / so) / (sxx - sx * sx / so + 0.0001 * s) AS w FROM (
   SELECT product_id, i, s, SUM(o) AS so, SUM(o * x) AS sx, SUM(o * y) AS sy, SUM(o * x * y) AS sxy, SUM(o * x * x) AS sxx
   FROM (SELECT f.product_id, f.i, f.s, q.x, q.y,
     COALESCE(LEAST(1.0, 1.35 * f.s / NULLIF(ABS(q.x * f.w + f.c - q.y), 0)), 1.0) AS o
    FROM {name} f JOIN {pts} q ON f.product_id = q.product_id WHERE f.i < 300)
   GROUP BY product_id, i, s)) u JOIN {pts} p ON u.product_id = p.product_id)
GROUP BY product_id, i, w, c, s"""


def trend(daily: str, fitted: str) -> str:
    return f"""
SELECT d.product_id, COALESCE({rd("f.w", 2)}, 0) AS lt_growth FROM (SELECT DISTINCT product_id FROM {daily}) d
LEFT JOIN (SELECT product_id, w FROM {fitted} WHERE i = 300) f ON d.product_id = f.product_id"""


for _set in ("all", "ok"):
    CTES[f"{_set}_monthly"] = monthly(f"{_set}_daily")
    CTES[f"{_set}_points"] = points(f"{_set}_monthly")
    CTES[f"{_set}_fit"] = fit(f"{_set}_points", f"{_set}_fit")
    CTES[f"{_set}_trend"] = trend(f"{_set}_daily", f"{_set}_fit")

# --- repurchases ------------------------------------------------------------------------


def totals(lines: str, top: str, days: int) -> str:
    return f"""
SELECT product_id, COUNT(*) AS purchase_count, COUNT(*) - COUNT(DISTINCT user_id) AS repurchase_count,
 COUNT(DISTINCT CASE WHEN rn > 1 THEN user_id END) AS repurchase_users FROM (
 SELECT product_id, user_id, ROW_NUMBER() OVER (PARTITION BY user_id, product_id ORDER BY purchased_at) AS rn
 FROM {lines} WHERE purchased_at BETWEEN {top} - {days} AND {top} AND user_id IS NOT NULL)
GROUP BY product_id"""


def index(total: str, orders: int, users: int) -> str:
    rate = rd("repurchase_count / CAST(purchase_count AS DOUBLE)", 2)
    breadth = rd("repurchase_users / CAST(repurchase_count AS DOUBLE)", 2)
    return f"""
SELECT product_id, repurchase_count, purchase_count, {rate} AS repurchase_rate, repurchase_users,
 {breadth} AS repurchase_user_rate, {rate} * {breadth} AS repurchase_index
FROM {total} WHERE repurchase_count >= {orders} AND repurchase_users >= {users}"""


CTES["all_totals_90"] = totals("lines", RUN_DAY, 90)
CTES["all_totals_180"] = totals("lines", RUN_DAY, 180)
CTES["all_index_180"] = index("all_totals_180", 30, 10)
CTES["ok_totals_90"] = totals("ok_lines", "(SELECT t FROM ok_top)", 90)
CTES["ok_totals_180"] = totals("ok_lines", "(SELECT t FROM ok_top)", 180)
CTES["ok_index_90"] = index("ok_totals_90", 3, 2)
CTES["ok_index_180"] = index("ok_totals_180", 30, 10)

# --- stock ------------------------------------------------------------------------------


def barcode_avg(lines: str) -> str:
    return f"""
SELECT barcode, AVG(q) AS avg_qty FROM (
 SELECT barcode, purchased_at, SUM(product_qty) AS q FROM {lines}
 WHERE purchased_at BETWEEN (SELECT MAX(purchased_at) FROM {lines}) - 90 AND (SELECT MAX(purchased_at) FROM {lines})
 GROUP BY ALL) GROUP BY barcode"""


def option_stock(lines: str, averages: str) -> str:
    return f"""
SELECT b.product_id, s.barcode, b.variant_name, s.amount AS stock,
 {ieee("CAST(s.amount AS DOUBLE)", "COALESCE(a.avg_qty, 1)")} AS dsi,
 {ieee("a.avg_qty", "SUM(a.avg_qty) OVER (PARTITION BY b.product_id)")} AS share
FROM (SELECT * FROM fx_stock WHERE day = (SELECT MAX(day) FROM fx_stock)) s LEFT JOIN {averages} a ON s.barcode = a.barcode
JOIN (SELECT DISTINCT product_id, barcode, variant_name FROM {lines}) b ON s.barcode = b.barcode"""


def top_two(rows: str) -> str:
    columns = []
    for n in (1, 2):
        for source, target in (("barcode", "barcode"), ("variant_name", "name"), ("stock", "stock")):
            columns.append(f"MAX(CASE WHEN rn = {n} THEN {source} END) AS opt{n}_{target}")
        columns.append(f"{rd(f'MAX(CASE WHEN rn = {n} THEN share END)', 2)} AS opt{n}_share")
        dsi = rd(f"MAX(CASE WHEN rn = {n} THEN dsi END)", 2)
        columns.append(f"{dsi if n == 1 else f'COALESCE({dsi}, 0)'} AS opt{n}_dsi")
    return f"""
SELECT product_id, {", ".join(columns)} FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY share DESC NULLS LAST, barcode, variant_name, stock) AS rn
 FROM ({rows})) GROUP BY product_id"""


_MOVED = (
    "SELECT CASE WHEN product_id = 24 THEN 26 ELSE product_id END AS product_id, "
    "barcode, variant_name, stock, dsi, share FROM {}"
)
CTES["all_barcode_avg"], CTES["opt_barcode_avg"] = barcode_avg("lines"), barcode_avg("opt_lines")
CTES["all_option_stock"] = option_stock("lines", "all_barcode_avg")
CTES["opt_option_stock"] = option_stock("opt_lines", "opt_barcode_avg")
CTES["all_turnover"] = top_two(_MOVED.format("all_option_stock"))
CTES["opt_turnover"] = top_two(_MOVED.format("opt_option_stock"))


def oos(lines: str, top: str) -> str:
    return f"""
SELECT product_id, COUNT(*) AS tracked_days, COUNT(*) FILTER (WHERE amount = 0) AS oos_days,
 COUNT(*) FILTER (WHERE amount = 0) / CAST(COUNT(*) AS DOUBLE) AS oos_rate FROM (
 SELECT b.product_id, s.day, SUM(s.amount) AS amount FROM fx_stock s
 JOIN (SELECT DISTINCT product_id, barcode FROM {lines}) b ON s.barcode IS NOT DISTINCT FROM b.barcode
 WHERE s.day >= {top} - 6 GROUP BY ALL) GROUP BY product_id"""


CTES["all_oos"], CTES["ok_oos"] = oos("hist", RUN_DAY), oos("ok_lines", "(SELECT t FROM ok_top)")

# --- exposure, reviews, searches --------------------------------------------------------
CTES["streak"] = """
SELECT l.product_id, l.main_rec_category, l.day AS latest_day, MIN(g.day) AS exposure_start FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY popularity DESC NULLS LAST, main_rec_category) AS rn
 FROM fx_exposure WHERE day = (SELECT MAX(day) FROM fx_exposure)) l
JOIN (SELECT product_id, day, MAX(day) OVER (PARTITION BY product_id, grp) AS last_day FROM (
  SELECT product_id, day, day - CAST(ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY day) AS INTEGER) AS grp
  FROM (SELECT DISTINCT product_id, day FROM fx_exposure))) g
 ON l.product_id = g.product_id AND g.last_day = l.day
WHERE l.rn = 1 GROUP BY ALL"""


def uplift(daily: str) -> str:
    shown = f"""(SELECT SUM(qty) FROM {daily} d WHERE d.product_id = s.product_id
   AND d.day BETWEEN s.exposure_start AND s.latest_day)"""
    control = f"""(SELECT SUM(qty) FROM {daily} d WHERE d.product_id = s.product_id
   AND d.day >= s.exposure_start - 7 AND d.day < s.exposure_start)"""
    return f"""
SELECT product_id, main_rec_category, exposure_start, {rd(ieee("e", "c"), 2)} AS exposure_uplift FROM (
 SELECT *, COALESCE({shown} / (latest_day - exposure_start + 1), 0) AS e, COALESCE({control} / 8, 1) AS c
 FROM streak s)"""


CTES["opt_daily"] = (
    "SELECT product_id, purchased_at AS day, SUM(product_qty) AS qty FROM opt_lines GROUP BY ALL"
)
CTES["all_uplift"], CTES["opt_uplift"] = uplift("all_daily"), uplift("opt_daily")


def review(top: str) -> str:
    return f"""
SELECT r.product_id, {rd("AVG(rating_value)", 2)} AS avg_rating, COUNT(DISTINCT post_id) AS review_count,
 {rd("AVG(LENGTH(message))", 2)} AS review_length, COUNT(*) FILTER (WHERE rating_value <= 3) AS negative_reviews,
 MAX(w.worst) AS negative_case
FROM fx_review r LEFT JOIN (
 SELECT product_id, message AS worst FROM fx_review WHERE rating_value <= 3 AND post_day >= {top} - 8
 QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY rating_value, post_id) = 1) w ON r.product_id = w.product_id
WHERE post_day >= {top} - 8 GROUP BY r.product_id"""


def search(top: str) -> str:
    return f"""
SELECT product_id, COUNT(DISTINCT idx) AS search_count FROM fx_search
WHERE day BETWEEN {top} - 7 AND {top} GROUP BY product_id"""


CTES["all_reviews"], CTES["ok_reviews"] = review(RUN_DAY), review("(SELECT t FROM ok_top)")
CTES["all_search"], CTES["ok_search"] = search(RUN_DAY), search("(SELECT t FROM ok_top)")

CTES["rated"] = f"""
SELECT product_id, {rd("AVG(rating_value)", 2)} AS r FROM fx_review WHERE product_id % 3 <> 0 GROUP BY product_id"""

# --- prices -----------------------------------------------------------------------------
CTES["crawled"] = """
SELECT competitor, product_id, sale_or_not FROM fx_crawl
WHERE competitor IN (SELECT competitor FROM cmpt)
QUALIFY ROW_NUMBER() OVER (PARTITION BY competitor, product_id ORDER BY update_date DESC, sale_or_not) = 1"""
CTES["statuses"] = """
SELECT competitor, product_id, status, CASE WHEN status = '정상수집' THEN krw_price END AS price FROM (
 SELECT COALESCE(p.competitor, c.competitor) AS competitor, COALESCE(p.product_id, c.product_id) AS product_id, krw_price,
  CASE WHEN sale_or_not = 0 THEN '미판매' WHEN krw_price = -1 OR usd_price = 0 OR krw_price IS NULL THEN '수집오류'
   ELSE '정상수집' END AS status
 FROM cmpt p FULL JOIN crawled c ON p.competitor = c.competitor AND p.product_id = c.product_id)"""
_COMPETITORS = ("11st", "Coupang", "Iherb", "Ople")


def _pivot_columns() -> str:
    columns = []
    for name in _COMPETITORS:
        key = f"competitor = '{name}'"
        columns.append(f"MIN(price) FILTER (WHERE {key}) AS price_{name.lower()}")
        columns.append(
            f"CASE WHEN COUNT(*) FILTER (WHERE {key} AND status = '정상수집') > 0 THEN '정상수집' "
            f"WHEN COUNT(*) FILTER (WHERE {key} AND status = '수집오류') > 0 THEN '수집오류' "
            f"WHEN COUNT(*) FILTER (WHERE {key}) > 0 THEN '미판매' END AS price_{name.lower()}_status"
        )
    return ", ".join(columns)


CTES["pivoted"] = f"SELECT product_id, {_pivot_columns()} FROM statuses GROUP BY product_id"
_ALL_FOUND = "(SELECT COUNT(DISTINCT competitor) = 4 FROM cmpt)"
_MATRIX = ", ".join(
    f"CASE WHEN {_ALL_FOUND} THEN price_{n.lower()} END AS price_{n.lower()}, "
    f"CASE WHEN {_ALL_FOUND} THEN COALESCE(price_{n.lower()}_status, '미수집') ELSE '수집오류' END "
    f"AS price_{n.lower()}_status"
    for n in _COMPETITORS
)
CTES["matrix"] = f"""
SELECT o.product_id, price_own, CASE WHEN price_own IS NULL THEN '미수집' ELSE '정상수집' END AS price_own_status,
 {_MATRIX} FROM fx_own o LEFT JOIN pivoted p ON o.product_id = p.product_id"""

# --- grades -----------------------------------------------------------------------------


def grade_ctes(tag: str, table: str, metrics: Sequence[str]) -> None:
    """One expression per metric and cut: each looks at the values below the one before."""
    for m in metrics:
        for n in range(10, 1, -1):
            below = "" if n == 10 else f" WHERE {m} < (SELECT c FROM {tag}_{m}_{n + 1})"
            CTES[f"{tag}_{m}_{n}"] = (
                f"SELECT CAST(MAX({m}) - (MAX({m}) - MIN({m})) / {n} AS DOUBLE) AS c FROM {table}{below}"
            )


def graded(tag: str, m: str) -> str:
    def cut(n: int) -> str:
        return f"(SELECT c FROM {tag}_{m}_{n})"

    arms = [f"WHEN {m} <= {cut(2)} THEN 1"]
    arms += [f"WHEN {m} > {cut(n)} AND {m} <= {cut(n + 1)} THEN {n}" for n in range(2, 10)]
    return f"CAST(CASE {' '.join(arms)} ELSE 10 END AS DOUBLE)"


_WEEKLY_METRICS = ("last_avg_qty", "past_avg_qty", "growth_rate")
grade_ctes("wk", "all_weekly", _WEEKLY_METRICS)
grade_ctes("oosg", "all_oos", ("oos_rate",))

# --- lists ------------------------------------------------------------------------------
_STOCK = [f"opt{n}_{part}" for n in (1, 2) for part in ("barcode", "name", "share", "stock", "dsi")]
_STOCK_NUMBERS = [c for c in _STOCK if not c.endswith(("barcode", "name"))]
_PRICES = [f"price_{n.lower()}" for n in ("own", *_COMPETITORS)]
_PRICE_CELLS = [c for p in _PRICES for c in (p, f"{p}_status")]
_SHOWN = ["main_rec_category", "exposure_start", "exposure_uplift"]


def cells(names: Sequence[str], means: Sequence[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in means else c for c in names)


def benchmark_cells(names: Sequence[str], means: Sequence[str]) -> str:
    return ", ".join(
        f"{rd(mean(c), 2)} AS {c}" if c in means else f"NULL AS {c}" for c in names
    )


GROWTH_CELLS = [
    *("product_id", "brand", "product_name", "growth_rate", "last_avg_qty", "past_avg_qty", "lt_growth"),
    *_PRICE_CELLS,
    *_STOCK,
    *_SHOWN,
]
GROWTH_MEANS = [
    *("growth_rate", "last_avg_qty", "past_avg_qty", "lt_growth", "price_own", "exposure_uplift"),
    *_STOCK_NUMBERS,
]
_NO_BRAND = "COALESCE(brand <> 'Jan Tana', TRUE)"
CTES["growth_items"] = f"""
SELECT {cells(GROWTH_CELLS, GROWTH_MEANS)} FROM ok_weekly w
LEFT JOIN (SELECT product_id, product_name FROM ok_names) USING (product_id)
LEFT JOIN fx_brand USING (product_id) LEFT JOIN ok_trend USING (product_id) LEFT JOIN opt_turnover USING (product_id)
LEFT JOIN matrix USING (product_id) LEFT JOIN opt_uplift USING (product_id)
WHERE {_NO_BRAND} AND (opt1_dsi + opt2_dsi >= 0 OR opt1_dsi IS NULL OR product_id = 31)
 AND (main_rec_category IS NULL OR exposure_uplift >= 1 OR product_id = 31)"""

REPURCHASE_BASE = [
    *("product_id", "brand", "product_name", "repurchase_index", "repurchase_rate", "repurchase_user_rate"),
    *("repurchase_count", "purchase_count", "repurchase_users", "last_avg_qty", "category_m", "category_s"),
    *_PRICE_CELLS,
    *_STOCK,
    *_SHOWN,
]
_REP_METRICS = ("repurchase_rate", "repurchase_user_rate", "last_avg_qty")
REPURCHASE_CELLS = [*REPURCHASE_BASE, *[f"{m}_grade" for m in _REP_METRICS], "score"]
REPURCHASE_MEANS = [
    *("repurchase_index", "repurchase_rate", "repurchase_user_rate", "repurchase_count", "purchase_count"),
    *("repurchase_users", "last_avg_qty", "price_own", "exposure_uplift", "score"),
    *[f"{m}_grade" for m in _REP_METRICS],
    *_STOCK_NUMBERS,
]
CTES["rep_base"] = f"""
SELECT {cells(REPURCHASE_BASE, REPURCHASE_MEANS)} FROM ok_index_90
JOIN ok_recent USING (product_id) LEFT JOIN ok_names USING (product_id) LEFT JOIN fx_brand USING (product_id)
LEFT JOIN opt_turnover USING (product_id) LEFT JOIN matrix USING (product_id) LEFT JOIN opt_uplift USING (product_id)
WHERE {_NO_BRAND} AND (opt1_dsi + opt2_dsi >= 2 OR opt1_dsi IS NULL OR product_id = 31)"""
grade_ctes("rep", "rep_base", _REP_METRICS)
CTES["rep_items"] = f"""
SELECT *, repurchase_rate_grade + repurchase_user_rate_grade + last_avg_qty_grade AS score FROM (
 SELECT *, {graded("rep", "repurchase_rate")} AS repurchase_rate_grade,
  {graded("rep", "repurchase_user_rate")} AS repurchase_user_rate_grade,
  {graded("rep", "last_avg_qty")} / 2 AS last_avg_qty_grade FROM rep_base)
WHERE main_rec_category IS NULL OR exposure_uplift >= 1"""

RANKING_NUMBERS = [
    *("last_avg_qty", "past_avg_qty", "growth_rate", "qoq_rate", "yoy_rate", "repurchase_index"),
    *("repurchase_count", "purchase_count", "repurchase_rate", "repurchase_users", "repurchase_user_rate"),
    *("avg_rating", "review_count", "review_length", "negative_reviews", "oos_days", "oos_rate"),
    *("search_count", "price_own", *_STOCK_NUMBERS),
]
RANKING_BASE = [
    *("product_id", "brand", "product_name", *_PRICE_CELLS),
    *[c for c in RANKING_NUMBERS if c != "price_own" and c not in _STOCK],
    *("negative_case", "category_m", "category_s", *_STOCK),
]
_RANK_METRICS = (
    *("last_avg_qty", "growth_rate", "qoq_rate", "yoy_rate", "repurchase_index", "search_count"),
)
CTES["rank_found"] = f"""
SELECT * FROM ok_weekly JOIN ok_index_180 USING (product_id) LEFT JOIN fx_brand USING (product_id)
LEFT JOIN ok_names USING (product_id) LEFT JOIN (SELECT product_id, yoy_rate FROM ok_yoy) USING (product_id)
LEFT JOIN (SELECT product_id, qoq_rate FROM ok_qoq) USING (product_id) LEFT JOIN ok_reviews USING (product_id)
LEFT JOIN (SELECT product_id, oos_days, oos_rate FROM ok_oos) USING (product_id)
LEFT JOIN ok_search USING (product_id) WHERE {_NO_BRAND}"""
_FILLED = {
    **{c: f"COALESCE({c}, 0)" for c in ("yoy_rate", "qoq_rate", "review_count", "review_length")},
    **{c: f"COALESCE({c}, 0)" for c in ("search_count", "negative_reviews")},
    "category_s": "COALESCE(category_s, '-')",
    "negative_case": "COALESCE(negative_case, '-')",
    "avg_rating": f"COALESCE(avg_rating, (SELECT {mean_of_cents('avg_rating')} FROM rank_found))",
}
CTES["rank_items"] = f"""
SELECT {cells(RANKING_BASE, RANKING_NUMBERS)} FROM (
 SELECT * REPLACE ({", ".join(f"{v} AS {c}" for c, v in _FILLED.items())}) FROM rank_found)
LEFT JOIN opt_turnover USING (product_id) LEFT JOIN matrix USING (product_id)
WHERE (opt1_dsi + opt2_dsi >= 0 OR opt1_dsi IS NULL OR product_id = 31) AND product_name IS NOT NULL"""
CTES["rank_all"] = f"""
SELECT 'item' AS row_kind, * FROM rank_items
UNION ALL SELECT 'benchmark' AS row_kind, {benchmark_cells(RANKING_BASE, RANKING_NUMBERS)} FROM rank_items"""
grade_ctes("rank", "rank_all", _RANK_METRICS)
_RANK_GRADES = ", ".join(
    f"{graded('rank', m)}{' * 4' if m == 'last_avg_qty' else ''} AS {m}_grade" for m in _RANK_METRICS
)
CTES["rank_scored"] = f"""
SELECT *, {" + ".join(f"{m}_grade" for m in _RANK_METRICS)} - negative_reviews * 2 AS score
FROM (SELECT *, {_RANK_GRADES} FROM rank_all) LEFT JOIN opt_uplift USING (product_id)"""
_ORDER = "{} DESC, last_avg_qty DESC, product_id"


def numbered(table: str, metric: str, where: str = "TRUE", first: str = "") -> str:
    order = first + _ORDER.format(metric)
    return (
        f"SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS INTEGER) AS rank "
        f"FROM {table} WHERE {where} ORDER BY rank LIMIT 50"
    )


CTES["rank_top"] = numbered("rank_scored", "score", "row_kind = 'item'")
CTES["rep_top"] = numbered(
    "rep_items", "score", "product_id NOT IN (SELECT product_id FROM rank_top WHERE rank <= 15)"
)
CTES["growth_first"] = numbered("growth_items", "growth_rate")
CTES["pin_needed"] = """
SELECT (SELECT in_stock FROM pin_state) AND 31 NOT IN (
 SELECT product_id FROM rank_top WHERE rank <= 15 UNION ALL SELECT product_id FROM rep_top WHERE rank <= 15
 UNION ALL SELECT product_id FROM growth_first WHERE rank <= 15) AS pin"""
CTES["growth_top"] = numbered(
    "growth_items",
    "growth_rate",
    "product_id NOT IN (SELECT product_id FROM rank_top WHERE rank <= 15) "
    "AND product_id NOT IN (SELECT product_id FROM rep_top)",
    "(product_id = 31 AND (SELECT pin FROM pin_needed)) DESC, ",
)
CTES["growth_placed"] = """
SELECT product_id, rank FROM growth_first WHERE rank <= 15 AND NOT (SELECT pin FROM pin_needed)
UNION ALL SELECT 31, 1 WHERE (SELECT pin FROM pin_needed)
UNION ALL SELECT product_id, rank + 1 FROM growth_first WHERE (SELECT pin FROM pin_needed)
 AND rank <= 15 AND rank < (SELECT MAX(rank) FROM growth_first WHERE rank <= 15)"""


def published(table: str, columns: dict[str, str]) -> str:
    parts = []
    for target, source in columns.items():
        if source.startswith("price_"):
            value = f"COALESCE(CAST({source} AS VARCHAR), {source}_status)"
        elif source == "date":
            value = RUN_DAY
        elif source in ("repurchase_index", "avg_rating"):
            value = rd(source, 4)
        else:
            value = source
        parts.append(f"{value} AS {target}")
    return f"SELECT {', '.join(parts)} FROM {table}"


# --- query texts ------------------------------------------------------------------------
SHIFT = "14 * 3600"
_EPOCH_DAY = "CAST(make_timestamp(({} + " + SHIFT + ") * 1000000) AS DATE)"
_RATIO = "marked_down_price / product_price * product_qty / 8"

QUERIES: dict[str, str] = {
    "src_sales": "SELECT * EXCLUDE (line_no) FROM hist",
    "src_cart": f"""
SELECT * EXCLUDE (timestamp), {_EPOCH_DAY.format("timestamp")} AS add_day FROM fx_cart
WHERE strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') BETWEEN '{CART_START}' AND '{CART_END}'""",
    "src_users": f"""
SELECT * EXCLUDE (timestamp) REPLACE (make_timestamp((last_login + {SHIFT}) * 1000000) AS last_login),
 {_EPOCH_DAY.format("timestamp")} AS register_day FROM fx_users""",
    "src_reviews": f"""
SELECT a.post_id, a.thread_id, d.object_id AS product_id, e.product, {_EPOCH_DAY.format("a.timestamp")} AS post_day,
 a.user_id, b.rating_value, REPLACE(REPLACE(REPLACE(c.message, CHR(13) || CHR(10), ' '), CHR(13), ' '), CHR(10), ' ')
  AS message, a.status
FROM fx_posts a, fx_ratings b, fx_messages c, fx_threads d, fx_names e
WHERE a.thread_id = b.thread_id AND a.post_id = b.post_id AND a.post_id = c.post_id AND a.thread_id = c.thread_id
 AND a.thread_id = d.thread_id AND d.object_type = 'P' AND d.object_id = e.product_id AND e.lang_code = 'ko'""",
    "src_brand": """
SELECT product_id, REPLACE(variant, CHR(9), '') AS brand FROM (
 SELECT f.product_id, v.variant, ROW_NUMBER() OVER (PARTITION BY f.product_id ORDER BY f.variant_id) AS rn
 FROM fx_feature f LEFT JOIN fx_variant v ON f.variant_id = v.variant_id AND f.lang_code = v.lang_code
 WHERE f.feature_id = 19 AND f.lang_code = 'ko') WHERE rn = 1""",
    "src_option_barcodes": "SELECT DISTINCT barcode FROM fx_sales WHERE product_id = 31",
    "latest_competitor_price": """
SELECT DISTINCT date, competitor, product_id, krw_price, usd_price FROM fx_cmpt_history
WHERE date = (SELECT MAX(date) FROM fx_cmpt_history)""",
    "latest_crawl_status": "SELECT * FROM crawled",
    "crawl_kept": "SELECT * FROM crawled",
    "own_price": """
SELECT product_id, MIN(krw_price) AS price_own FROM fx_item i JOIN fx_item_price p ON i.id = p.item_id
WHERE date = (SELECT MAX(date) FROM fx_item_price) GROUP BY product_id""",
    "filter_window": "SELECT product_id, day, qty FROM all_daily, all_top WHERE day BETWEEN t - 7 AND t",
    "filter_not_in_keep_null": """
SELECT category_m, COUNT(*) AS lines FROM hist
WHERE category_m NOT IN ('excluded') OR category_m IS NULL GROUP BY category_m""",
    "filter_status": """
SELECT d.* FROM all_daily d LEFT JOIN fx_status s ON d.product_id = s.product_id
WHERE s.status IS NULL OR s.status NOT IN ('D', 'H')""",
    "semi_join_recent_sellers": """
SELECT product_id, day, qty FROM all_daily, all_top WHERE day BETWEEN t - 7 AND t AND product_id IN (
 SELECT product_id FROM all_daily, all_top WHERE day BETWEEN t - 7 AND t GROUP BY 1 HAVING SUM(qty) > 6)""",
    "filter_substitutes": f"""
SELECT * FROM all_daily WHERE product_id NOT IN (
 SELECT product_id FROM all_daily WHERE product_id IN (20, 21) AND day >= {RUN_DAY} - 90 GROUP BY 1
 HAVING SUM(qty) < (SELECT MAX(q) FROM (SELECT SUM(qty) AS q FROM all_daily
  WHERE product_id IN (20, 21) AND day >= {RUN_DAY} - 90 GROUP BY product_id)))""",
    "clean_message": """
SELECT thread_id, post_id,
 REPLACE(REPLACE(REPLACE(message, CHR(13) || CHR(10), ' '), CHR(13), ' '), CHR(10), ' ') AS message FROM fx_messages""",
    "np_round": f"SELECT order_id, product_id, {rd(_RATIO, 2)} AS r2, {rd(_RATIO, 4)} AS r4 FROM hist",
    "case_price_status": "SELECT * FROM statuses",
    "join_full_zero_fill": """
SELECT * FROM (
 SELECT COALESCE(d.product_id, s.product_id) AS product_id, COALESCE(d.day, s.day) AS day,
  COALESCE(d.qty, 0) AS qty, s.day IS NOT NULL AS stocked
 FROM all_daily d FULL JOIN all_stock_left s ON d.product_id = s.product_id AND d.day = s.day)
WHERE day BETWEEN (SELECT t FROM all_top) - 35 AND (SELECT t FROM all_top)""",
    "join_left_dims": """
SELECT s.product_id, s.qty, n.product_name, b.brand FROM (SELECT product_id, SUM(qty) AS qty FROM all_daily GROUP BY 1) s
LEFT JOIN all_names n ON s.product_id = n.product_id LEFT JOIN fx_brand b ON s.product_id = b.product_id""",
    "join_null_safe_barcode": """
SELECT p.product_id, s.day, s.amount FROM (
 SELECT CASE WHEN CAST(barcode AS BIGINT) % 7 <> 0 THEN barcode END AS barcode, day, CAST(SUM(amount) AS BIGINT) AS amount
 FROM fx_stock GROUP BY 1, 2) s
JOIN (SELECT DISTINCT product_id, CASE WHEN CAST(barcode AS BIGINT) % 7 <> 0 THEN barcode END AS barcode FROM hist) p
 ON s.barcode IS NOT DISTINCT FROM p.barcode""",
    "agg_daily_sales": "SELECT * FROM all_daily",
    "rollup_kept": "SELECT * FROM all_daily",
    "agg_barcode_avg": "SELECT * FROM all_barcode_avg",
    "agg_windowed_avg": """
SELECT product_id, AVG(qty) FILTER (WHERE day BETWEEN t - 7 AND t) AS avg_7,
 AVG(qty) FILTER (WHERE day BETWEEN t - 30 AND t) AS avg_30, AVG(qty) FILTER (WHERE day BETWEEN t - 90 AND t) AS avg_90
FROM all_daily, all_top GROUP BY product_id""",
    "agg_distinct_users": """
SELECT product_id, COUNT(DISTINCT user_id) AS users, COUNT(*) AS lines FROM lines GROUP BY product_id""",
    "agg_conditional_count": """
SELECT product_id, COUNT(CASE WHEN rating_value <= 3 THEN 1 END) AS negative, COUNT(rating_value) AS rated
FROM fx_review GROUP BY product_id""",
    "pivot_prices": "SELECT * FROM pivoted",
    "fill_null_mean": f"""
SELECT p.product_id, {rd(f"COALESCE(r, (SELECT {mean_of_cents('r')} FROM rated))", 4)} AS avg_rating
FROM (SELECT DISTINCT product_id FROM fx_sales) p LEFT JOIN rated ON p.product_id = rated.product_id""",
    "mean_extremes": f"""
SELECT product_id, AVG({ieee("qty", "CAST(CASE WHEN DAY(day) = 1 AND product_id % 7 = 0 THEN 0 ELSE 1 END AS DOUBLE)")}) AS rate,
 AVG(qty * 18446744073709551616e0) AS huge, AVG(qty / 1099511627776e0) AS tiny
FROM all_daily GROUP BY product_id""",
    "monthly_sales": "SELECT * FROM all_monthly",
    "win_latest_stock": """
SELECT barcode, amount FROM (
 SELECT barcode, amount, ROW_NUMBER() OVER (PARTITION BY barcode ORDER BY day DESC, amount DESC) AS rn FROM fx_stock)
WHERE rn = 1""",
    "stock_kept": """
SELECT barcode, amount FROM (
 SELECT barcode, amount, ROW_NUMBER() OVER (PARTITION BY barcode ORDER BY day DESC, amount DESC) AS rn FROM fx_stock)
WHERE rn = 1""",
    "win_top2_options": top_two("all_option_stock").replace("(all_option_stock)", "all_option_stock"),
    "last_known_name": "SELECT * FROM all_names",
    "win_repurchase_rows": f"""
SELECT product_id, user_id, COUNT(*) AS repurchases FROM (
 SELECT product_id, user_id, ROW_NUMBER() OVER (PARTITION BY user_id, product_id ORDER BY purchased_at) AS rn
 FROM lines WHERE purchased_at BETWEEN {RUN_DAY} - 180 AND {RUN_DAY}) WHERE rn > 1 GROUP BY 1, 2""",
    "topk_ranking": f"""
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY {_ORDER.format("last_avg_qty")}) AS INTEGER) AS rank
FROM all_recent ORDER BY rank LIMIT 15""",
    "stock_turnover": "SELECT * FROM all_turnover",
    "exposure_streak": "SELECT * FROM streak",
    "exposure_steps": "SELECT * FROM streak",
    "exposure_uplift": "SELECT * FROM all_uplift",
    "ltgr": "SELECT * FROM all_trend",
    "growth_weekly": "SELECT * FROM all_weekly",
    "growth_yoy": "SELECT * FROM all_yoy",
    "growth_qoq": "SELECT * FROM all_qoq",
    "recent_avg": "SELECT * FROM all_recent",
    "repurchase_rate": f"""
SELECT product_id, repurchase_count, purchase_count,
 {rd("repurchase_count / CAST(purchase_count AS DOUBLE)", 2)} AS repurchase_rate FROM all_totals_90""",
    "repurchase_breadth": """
SELECT product_id, repurchase_users, repurchase_count, repurchase_user_rate FROM all_index_180""",
    "repurchase_index": "SELECT * FROM all_index_180",
    "review_summary": "SELECT * FROM all_reviews",
    "oos_rate": "SELECT * FROM all_oos",
    "search_inflow": "SELECT * FROM all_search",
    "price_matrix": "SELECT * FROM matrix",
    "price_score": """
SELECT product_id, CAST(CASE WHEN price_coupang IS NULL AND other IS NULL THEN 4 ELSE
  CASE WHEN price_coupang IS NULL THEN 0 WHEN price_own <= price_coupang THEN 2 ELSE -2 END
  + CASE WHEN other IS NULL THEN 0 WHEN price_own <= other THEN 1 ELSE -1 END END AS DOUBLE) AS price_score
FROM (SELECT *, LEAST(price_11st, price_iherb, price_ople) AS other FROM matrix)""",
    "pinned_guard": "SELECT * FROM all_daily WHERE product_id <> 31 OR (SELECT in_stock FROM pin_state)",
    "grade_scores": "SELECT product_id, "
    + ", ".join(f"{graded('wk', m)} AS {m}_grade" for m in _WEEKLY_METRICS)
    + " FROM all_weekly",
    "grade_reverse": f"SELECT product_id, 11 - {graded('oosg', 'oos_rate')} AS oos_rate_grade FROM all_oos",
    "final_score": f"""
SELECT w.product_id, {graded("wk", "last_avg_qty")} * 4 + {graded("wk", "past_avg_qty")} + {graded("wk", "growth_rate")}
 - COALESCE(r.n, 0) * 2 AS score
FROM all_weekly w LEFT JOIN (SELECT product_id, COUNT(*) AS n FROM fx_review WHERE rating_value <= 3 GROUP BY 1) r
 ON w.product_id = r.product_id""",
    "benchmark_row": f"""
SELECT 'item' AS row_kind, product_id, last_avg_qty, past_avg_qty, growth_rate FROM all_weekly
UNION ALL SELECT 'benchmark' AS row_kind, {benchmark_cells(("product_id", *_WEEKLY_METRICS), _WEEKLY_METRICS)} FROM all_weekly""",
    "filter_turnover": """
SELECT product_id, opt1_dsi, opt2_dsi FROM all_turnover
WHERE opt1_dsi + opt2_dsi >= 2 OR opt1_dsi IS NULL OR product_id = 31""",
    "filter_exposure": """
SELECT s.product_id, main_rec_category, exposure_start, exposure_uplift
FROM (SELECT DISTINCT product_id FROM all_daily) s LEFT JOIN all_uplift u ON s.product_id = u.product_id
WHERE main_rec_category IS NULL OR exposure_uplift >= 1 OR s.product_id = 31""",
    "list_growth": f"""
SELECT 'item' AS row_kind, {", ".join(GROWTH_CELLS)} FROM growth_items
UNION ALL SELECT 'benchmark' AS row_kind, {benchmark_cells(GROWTH_CELLS, GROWTH_MEANS)} FROM growth_items""",
    "list_repurchase": f"""
SELECT 'item' AS row_kind, {", ".join(REPURCHASE_CELLS)} FROM rep_items
UNION ALL SELECT 'benchmark' AS row_kind, {benchmark_cells(REPURCHASE_CELLS, REPURCHASE_MEANS)} FROM rep_items""",
    "list_ranking": """
SELECT * FROM rank_top UNION ALL BY NAME SELECT * FROM rank_scored WHERE row_kind = 'benchmark'""",
    "lists_exclusive": """
SELECT 'ranking' AS list, product_id, rank FROM rank_top UNION ALL SELECT 'repurchase', product_id, rank FROM rep_top
UNION ALL SELECT 'growth', product_id, rank FROM growth_top""",
    "placement_list": f"""
SELECT product_id AS PRODUCT_ID, {RUN_DAY} AS DATE, zone AS MAIN_REC_CATEGORY, CAST(rank AS INTEGER) AS LOCATION FROM (
 SELECT product_id, rank, '주간 랭킹' AS zone FROM rank_top WHERE rank <= 15
 UNION ALL SELECT product_id, rank, '재구매율 높은' FROM rep_top WHERE rank <= 15
 UNION ALL SELECT product_id, rank, '판매 급상승' FROM growth_placed)""",
}


# The published columns in order, each with the column it shows.
_PUBLISHED = {
    ("published_ranking", "rank_top"): """
BRAND brand, PRODUCT_NAME_KOR product_name, SCORE_TOTAL score, SCORE_AVG_QTY last_avg_qty_grade,
SCORE_GRWRATE_WEEK growth_rate_grade, SCORE_GRWRATE_QUT qoq_rate_grade,
SCORE_GRWRATE_YEAR yoy_rate_grade, SCORE_REPCHS repurchase_index_grade,
SCORE_SEARCH search_count_grade, SCORE_NEG_RVW negative_reviews, PRICE_MZ price_own,
PRICE_11ST price_11st, PRICE_COUPANG price_coupang, PRICE_IHERB price_iherb,
PRICE_OPLE price_ople, LAST_AVG_QTY last_avg_qty, PAST_AVG_QTY past_avg_qty,
GRWRATE_WEEK growth_rate, GRWRATE_QUT qoq_rate, GRWRATE_YEAR yoy_rate,
REPCHS_INDEX repurchase_index, REPCHS_CNT repurchase_count, PCHS_CNT purchase_count,
REPCHS_CNT_RATE repurchase_rate, REPCHS_USER repurchase_users,
REPCHS_USER_RATE repurchase_user_rate, AVG_RATING avg_rating, RVW_CNT review_count,
RVW_LENGTH review_length, NEG_RVW_CASE negative_case, OOS_DAYS oos_days, OOS_RATE oos_rate,
SEARCH_NUM search_count, PRODUCT_ID product_id, CATEGORY_M category_m, CATEGORY_S category_s,
OPTION_BARCODE_1ST opt1_barcode, OPTION_NAME_1ST opt1_name, OPTION_SALE_RATE_1ST opt1_share,
OPTION_STCK_1ST opt1_stock, OPTION_DSI_1ST opt1_dsi, OPTION_BARCODE_2ND opt2_barcode,
OPTION_NAME_2ND opt2_name, OPTION_SALE_RATE_2ND opt2_share, OPTION_STCK_2ND opt2_stock,
OPTION_DSI_2ND opt2_dsi, MAIN_REC_LAST_CATEGORY main_rec_category,
MAIN_REC_START_DATE exposure_start, MAIN_REC_GRWRATE exposure_uplift, DATE date, RANK_NUM rank""",
    ("published_repurchase", "rep_top"): """
BRAND brand, PRODUCT_NAME_KOR product_name, SCORE_TOTAL score,
SCORE_REPCHS_CNT_RATE repurchase_rate_grade, SCORE_REPCHS_USER_RATE repurchase_user_rate_grade,
SCORE_AVG_QTY last_avg_qty_grade, REPCHS_INDEX repurchase_index, PRICE_MZ price_own,
PRICE_11ST price_11st, PRICE_COUPANG price_coupang, PRICE_IHERB price_iherb,
PRICE_OPLE price_ople, REPCHS_CNT_RATE repurchase_rate, REPCHS_USER_RATE repurchase_user_rate,
REPCHS_CNT repurchase_count, PCHS_CNT purchase_count, REPCHS_USER repurchase_users,
LAST_AVG_QTY last_avg_qty, OPTION_STCK_1ST opt1_stock, OPTION_DSI_1ST opt1_dsi,
OPTION_SALE_RATE_1ST opt1_share, OPTION_STCK_2ND opt2_stock, OPTION_DSI_2ND opt2_dsi,
OPTION_SALE_RATE_2ND opt2_share, PRODUCT_ID product_id, OPTION_BARCODE_1ST opt1_barcode,
OPTION_BARCODE_2ND opt2_barcode, CATEGORY_M category_m, CATEGORY_S category_s,
OPTION_NAME_1ST opt1_name, OPTION_NAME_2ND opt2_name, MAIN_REC_LAST_CATEGORY main_rec_category,
MAIN_REC_START_DATE exposure_start, MAIN_REC_GRWRATE exposure_uplift, DATE date, RANK_NUM rank""",
    ("published_growth", "growth_top"): """
BRAND brand, PRODUCT_NAME_KOR product_name, GRWRATE growth_rate, LAST_AVG_QTY last_avg_qty,
PAST_AVG_QTY past_avg_qty, PRICE_MZ price_own, PRICE_11ST price_11st,
PRICE_COUPANG price_coupang, PRICE_IHERB price_iherb, PRICE_OPLE price_ople,
LT_GRWRATE lt_growth, OPTION_NAME_1ST opt1_name, OPTION_STCK_1ST opt1_stock,
OPTION_DSI_1ST opt1_dsi, OPTION_SALE_RATE_1ST opt1_share, OPTION_NAME_2ND opt2_name,
OPTION_STCK_2ND opt2_stock, OPTION_DSI_2ND opt2_dsi, OPTION_SALE_RATE_2ND opt2_share,
PRODUCT_ID product_id, OPTION_BARCODE_1ST opt1_barcode, OPTION_BARCODE_2ND opt2_barcode,
MAIN_REC_LAST_CATEGORY main_rec_category, MAIN_REC_START_DATE exposure_start,
MAIN_REC_GRWRATE exposure_uplift, DATE date, RANK_NUM rank""",
}
for (_key, _source), _columns in _PUBLISHED.items():
    QUERIES[_key] = published(_source, dict(c.split() for c in _columns.split(",")))


def statement(query: str, other: dict[str, str] | None = None) -> str:
    """The query with all the expressions it needs, each after those it uses. `other` has texts
    to be used in place of the usual ones."""
    order: list[str] = []
    known = CTES | (other or {})

    def _text(name: str) -> str:
        return known[name] if name in known else view_text(name, "duckdb")

    def need(text: str, owner: str | None = None) -> None:
        for word in dict.fromkeys(re.findall(r"[a-zA-Z_][a-zA-Z0-9_]*", text)):
            if (word in known or word in VIEWS) and word != owner and word not in order:
                need(_text(word), word)
                order.append(word)

    need(query)
    parts = [
        f"{n} AS ({_text(n)})" if n.endswith("_fit") else f"{n} AS MATERIALIZED ({_text(n)})"
        for n in order
    ]
    return f"WITH RECURSIVE {', '.join(parts)} {query}" if parts else query


# Reviews and brands as the readers find them: joined from their tables, not the views that
# those were made of.
CTES["raw_reviews"] = QUERIES["src_reviews"]
_FROM_TABLES = {
    "ok_reviews": CTES["ok_reviews"].replace("fx_review", "raw_reviews"),
    "fx_brand": QUERIES["src_brand"],
}
CTES["ok_totals_60"] = totals("ok_lines", "(SELECT t FROM ok_top)", 60)
_NEWEST = "(SELECT MAX(day) FROM fx_stock)"
_PLACEMENT = QUERIES["placement_list"]
_GROWTH_PLACED_EXCLUSIVE = """
SELECT product_id, rank FROM growth_top WHERE rank <= 15 AND NOT (SELECT pin FROM pin_needed)
UNION ALL SELECT 31, 1 WHERE (SELECT pin FROM pin_needed)
UNION ALL SELECT product_id, place + 1 FROM (
 SELECT product_id, ROW_NUMBER() OVER (ORDER BY rank) AS place FROM growth_top WHERE rank <= 15 AND product_id <> 31)
WHERE (SELECT pin FROM pin_needed) AND place < (SELECT GREATEST(COUNT(*), 1) FROM growth_top WHERE rank <= 15)"""


def pinned(text: str, product: int) -> str:
    """The same with another pinned product; its number stands nowhere else."""
    return re.sub(r"(?<![\d.-])31(?![\d.])", str(product), text)


STATEMENTS = {
    "src_products": statement(
        "SELECT product_id, CAST(NULL AS VARCHAR) AS is_edp, status, CAST(NULL AS VARCHAR) AS hash_tag FROM fx_status"
    ),
    "src_stock": statement(f"SELECT * FROM fx_stock WHERE day >= {RUN_DAY} - 9"),
    "src_stock_newest": statement(f"SELECT * FROM fx_stock WHERE day = {_NEWEST}"),
    "src_exposure": statement("SELECT * FROM fx_exposure"),
    "src_search": statement(f"SELECT * FROM fx_search WHERE day >= {RUN_DAY} - 9"),
    "list_repurchase_60": statement(
        QUERIES["list_repurchase"], _FROM_TABLES | {"ok_index_90": index("ok_totals_60", 3, 2)}
    ),
    "placement_from_tables": statement(_PLACEMENT, _FROM_TABLES),
    "placement_exclusive": statement(
        _PLACEMENT, _FROM_TABLES | {"growth_placed": _GROWTH_PLACED_EXCLUSIVE}
    ),
    "placement_pinned": pinned(statement(_PLACEMENT, _FROM_TABLES), 10),
    "placement_pinned_sold_out": pinned(statement(_PLACEMENT, _FROM_TABLES), 22),
}


def oracle_sql() -> dict[str, str]:
    return {name: statement(text) for name, text in QUERIES.items()} | STATEMENTS
