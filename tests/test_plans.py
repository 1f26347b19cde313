"""Whole runs: from raw tables to published tables, the pinned product, and stability."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import shelfpulse
from queries.catalog import REPURCHASE_OPTIONS, Run
from queries.views import RUN_DATE, SHOP, Fixtures, raw_frames
from shelfpulse.config import GROWTH_ZONE, ShopConfig
from shelfpulse.functions import within
from shelfpulse.operators.sales import option_days
from shelfpulse.plans import (
    Inputs,
    KeptNewest,
    KeptRollup,
    Published,
    Signals,
    exclusive_lists,
    growth_list,
    kept_crawls,
    kept_stock,
    placement_list,
    publish,
    run,
)
from shelfpulse.plans.placement import ListRun
from shelfpulse.plans.publish import (
    GROWTH_COLUMNS,
    PLACEMENT_COLUMNS,
    RANKING_COLUMNS,
    REPURCHASE_COLUMNS,
    with_competitors,
    write_table,
)
from shelfpulse.plans.signals import side_by_side
from shelfpulse.session import Staging
from shelfpulse.operators.stock import latest_stock
from shelfpulse.sources import (
    DatedHistory,
    DayHistory,
    EpochHistory,
    Tables,
    crawl_status,
    exposure_history,
    newest_crawls,
    stock_history,
)
from shelfpulse.sources.ledger import Ledger
from shelfpulse.sources.schemas import SCHEMAS

LIBRARY = Path(shelfpulse.__file__).parent


@pytest.fixture(scope="module")
def raw_tables(spark, sf_dir, tmp_path_factory):
    """The views as a folder of raw tables, with epochs as a shop keeps them."""
    root = tmp_path_factory.mktemp("tables")
    fx = Fixtures(spark, sf_dir)
    for name, frame in raw_frames(fx).items():
        frame.write.parquet(f"{root}/{name}")
    return str(root)


def test_every_declared_table_has_a_reader(raw_tables, spark):
    tables = Tables(spark, root=raw_tables)
    for name in set(SCHEMAS) - {"cart", "users"}:
        assert not tables.load(name).isEmpty()
    with pytest.raises(ValueError):
        Tables(spark)


def test_weekly_job_writes_four_tables(raw_tables, spark, tmp_path):
    inputs = Inputs.from_tables(Tables(spark, root=raw_tables), RUN_DATE, SHOP)
    target = str(tmp_path / "published")
    folders = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(folders.glob("shelfpulse-*"))
    for day in (RUN_DATE, RUN_DATE - timedelta(days=7), RUN_DATE):
        run(spark, inputs, day, target, SHOP)
    expected = {
        "placement": PLACEMENT_COLUMNS,
        "ranking": RANKING_COLUMNS,
        "repurchase": REPURCHASE_COLUMNS,
        "growth": GROWTH_COLUMNS,
    }
    expected = {n: with_competitors(c, SHOP.competitors) for n, c in expected.items()}
    assert [len(c) for c in expected.values()] == [4, 51, 36, 27]
    for name, columns in expected.items():
        written = Published(spark, target).read(name)
        assert written.columns == [*columns, "run_date"]
        if name == "repurchase":  # the usual thresholds leave none on the test tables
            assert written.isEmpty()
        else:
            days = {r.run_date for r in written.select("run_date").distinct().collect()}
            assert days == {RUN_DATE, RUN_DATE - timedelta(days=7)}
    ranks = sorted(r.RANK_NUM for r in Published(spark, target).read("ranking", RUN_DATE).collect())
    assert ranks == list(range(1, len(ranks) + 1))
    assert set(folders.glob("shelfpulse-*")) <= before, "runs clean up"


def test_a_failed_week_stays_as_it_was(spark, tmp_path, monkeypatch):
    published = Published(spark, str(tmp_path))
    names = ["placement", "ranking", "repurchase", "growth"]

    def week(value):
        return {n: spark.createDataFrame([(n, value)], "name string, value int") for n in names}

    def seen():
        return {n: [tuple(r) for r in published.read(n, RUN_DATE).collect()] for n in names}

    def versions():
        return [len(list(tmp_path.glob(f"{n}/run_date=*/version=*"))) for n in names]

    published.write(week(1), RUN_DATE)
    published.write({n: df.limit(0) for n, df in week(0).items()}, RUN_DATE - timedelta(days=7))
    old = seen()
    assert old == {n: [(n, 1, RUN_DATE)] for n in names}
    written = []

    def third_fails(df, folder):
        written.append(folder)
        if len(written) == 3:
            raise OSError("lost")
        write_table(df, folder)

    with monkeypatch.context() as patch:
        patch.setattr(publish, "write_table", third_fails)
        with pytest.raises(OSError):
            published.write(week(2), RUN_DATE)
    assert len(written) == 3 and seen() == old and versions() == [3, 3, 2, 2]
    with monkeypatch.context() as patch:  # all written, but not entered
        patch.setattr(publish.Ledger, "add", lambda self, record: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            published.write(week(2), RUN_DATE)
    assert seen() == old
    published.write(week(3), RUN_DATE)
    assert seen() == {n: [(n, 3, RUN_DATE)] for n in names}
    assert versions() == [3] * 4, "the current and the last version of one week, one of the other"
    assert published.days() == sorted(d.isoformat() for d in (RUN_DATE, RUN_DATE - timedelta(days=7)))
    assert published.read("growth").count() == 1
    with pytest.raises(ValueError):
        published.read("growth", RUN_DATE + timedelta(days=7))


def test_a_record_is_never_replaced(spark, tmp_path):
    ledger = Ledger(spark, f"{tmp_path}/ledger")
    assert ledger.newest() is None
    assert [ledger.add({"n": i}) for i in range(3)] == [1, 2, 3]
    ledger.numbers = lambda: [2]  # another run took number 3 meanwhile
    with pytest.raises(Exception, match="exist"):
        ledger.add({"n": 9})
    assert Ledger(spark, ledger.path).newest() == {"n": 2}


SOLD = "product_id long, barcode string, variant_name string, product_name string, category_m string, category_s string, purchased_at timestamp, product_qty double"


def sold(spark, days):
    """One line per product and number of the day, some of them at midnight."""
    rows = [
        (p, f"b{p}", None, f"n{p}", "c", None, datetime(2024, 1, 1) + timedelta(days=d, hours=7 * (p % 3)), q)
        for p, d, q in days
    ]
    return spark.createDataFrame(rows, SOLD)


def test_kept_rollup_reads_new_days_only(spark, tmp_path):
    first_day, lines = date(2024, 1, 1), sold(spark, [(p, d, float(d)) for p in range(5) for d in range(60)])
    asked = []

    def between(table):
        def load(since, until):
            asked.append(((since - first_day).days, (until - first_day).days))
            return table.filter(within(F.col("purchased_at"), since, until))

        return load

    def whole(table, start, end):
        return rows_of(option_days(between(table)(start, end)))

    def at(n):
        return first_day + timedelta(days=n)

    kept = KeptRollup(spark, str(tmp_path / "rollup"))
    assert rows_of(kept.update(between(lines), at(0), at(30))) == whole(lines, at(0), at(30))
    # A week later: the new days, the last seven and the running one are read; late lines count.
    late = lines.unionByName(sold(spark, [(1, 25, 100.0), (9, 26, 1.0)]))
    asked.clear()
    found = kept.update(between(late), at(4), at(37))
    assert asked == [(23, 37), (37, 37)]
    assert rows_of(found) == whole(late, at(4), at(37))
    folders = set(re.findall(r"batch=\w+/day=([-\d]+)", " ".join(kept.read(at(23), at(36)).inputFiles())))
    assert folders == {at(n).isoformat() for n in range(23, 37)}, "days of replaced batches are not opened"
    # The same week again, an earlier one, one after a long pause, and one that begins earlier.
    for start, end in ((4, 37), (2, 31), (20, 60), (0, 60), (58, 60)):
        again = KeptRollup(spark, str(tmp_path / "rollup")).update(between(late), at(start), at(end))
        assert rows_of(again) == whole(late, at(start), at(end)), (start, end)
    empty = KeptRollup(spark, str(tmp_path / "none"))
    assert empty.update(between(lines.limit(0)), at(0), at(9)).isEmpty()


def test_kept_rollup_survives_a_failed_run(spark, tmp_path, monkeypatch):
    lines = sold(spark, [(p, d, 1.0) for p in range(3) for d in range(20)])
    load = lambda a, b: lines.filter(within(F.col("purchased_at"), a, b))
    kept = KeptRollup(spark, str(tmp_path))
    start, end = date(2024, 1, 1), date(2024, 1, 11)
    before = rows_of(kept.update(load, start, end))
    with monkeypatch.context() as patch:
        patch.setattr(kept.ledger, "add", lambda record: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.update(load, start, end + timedelta(days=7))
    assert rows_of(kept.update(load, start, end)) == before


def test_lists_from_a_kept_rollup(raw_tables, spark, tmp_path):
    kept = KeptRollup(spark, str(tmp_path / "rollup"))
    tables = Tables(spark, root=raw_tables)
    Inputs.from_tables(tables, RUN_DATE - timedelta(days=7), SHOP, kept=kept)
    found = []
    for rollup in (None, kept):
        staging = Staging(spark)
        signals = Signals(spark, Inputs.from_tables(tables, RUN_DATE, SHOP, kept=rollup), SHOP, RUN_DATE, staging=staging)
        found.append(rows_of(signals.options))
        staging.drop()
    assert found[0] == found[1]


STOCKED = "barcode string, amount bigint, recorded_at timestamp, day date"


def counted(spark, rows):
    """Stock records: barcode, amount, number of the day (None: no time) and hour."""
    first = datetime(2024, 1, 1)
    times = [first + timedelta(days=d, hours=h) if d is not None else None for _, _, d, h in rows]
    made = [(b, a, t, t and t.date()) for (b, a, _, _), t in zip(rows, times, strict=True)]
    return spark.createDataFrame(made, STOCKED)


class Asked(DayHistory):
    """A history that notes from which day on it is read."""

    def __init__(self, frame, asked):
        super().__init__(frame)
        self.asked = asked

    def all(self):
        self.asked.append(None)
        return super().all()

    def since(self, day):
        self.asked.append(day)
        return super().since(day)


def test_kept_stock_reads_its_table_and_new_days(spark, tmp_path):
    rows = [(f"b{i % 7}", i * 5 % 11, i % 40, i % 3) for i in range(300)]
    rows += [("b0", None, 39, 2), ("gone", 4, 2, 0), (None, 3, 5, 0), ("timeless", 8, None, 0)]
    asked = []
    for today, shown in ((9, 10), (19, 20), (19, 20), (39, 40), (39, 40)):
        seen = [r for r in rows if r[2] is None or r[2] < shown]
        # Late by a week, from the second run on.
        seen += [("b1", 77, 3, 23)] if shown > 10 else []
        whole = counted(spark, seen)
        kept = kept_stock(spark, str(tmp_path / "stock"))
        state = kept.update(Asked(whole, asked), date(2024, 1, 1) + timedelta(days=today))
        assert rows_of(latest_stock(state)) == rows_of(latest_stock(whole)), shown
        assert rows_of(kept.read()) == rows_of(state)
        assert state.count() == whole.select("barcode").distinct().count()
    first = date(2024, 1, 1)
    assert asked == [None, *(first + timedelta(days=n) for n in (2, 12, 12, 32))]
    assert len([n for n in (tmp_path / "stock").iterdir() if n.name.startswith("version=")]) == 2


def test_kept_stock_of_wrong_clocks_failures_and_no_rows(spark, tmp_path, monkeypatch):
    path, today = str(tmp_path / "stock"), date(2024, 1, 10)
    rows = [("a", 1, 5, 0), ("a", 2, 900, 0), ("b", 3, 9, 0)]  # one record of years ahead
    before = rows_of(kept_stock(spark, path).update(DayHistory(counted(spark, rows)), today))
    kept = kept_stock(spark, path)
    with monkeypatch.context() as patch:
        patch.setattr(kept.ledger, "add", lambda record: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.update(DayHistory(counted(spark, [*rows, ("b", 9, 12, 0)])), today)
    assert rows_of(kept_stock(spark, path).read()) == before
    later = [*rows, ("b", 4, 11, 0), ("c", 5, 12, 0)]
    found = kept.update(DayHistory(counted(spark, later)), today + timedelta(days=7))
    assert {r.barcode: r.amount for r in found.collect()} == {"a": 2, "b": 4, "c": 5}
    empty = kept_stock(spark, str(tmp_path / "none"))
    for rows in ([], [], [("a", 1, 0, 0)]):
        assert empty.update(DayHistory(counted(spark, rows)), today).count() == len(rows)


def test_kept_crawls_keep_the_rule_for_equal_times(spark, tmp_path):
    def crawled(*rows):
        return spark.createDataFrame(
            [(c, p, datetime(2024, 1, 1 + d, 1, 2, 3, 4567), f) for c, p, d, f in rows],
            "competitor string, product_id bigint, update_date timestamp, sale_or_not bigint",
        )

    early = [("x", 1, 0, 1), ("x", 1, 3, 1), ("x", 2, 3, 0), ("y", 1, 2, None), ("y", 2, 1, 1)]
    late = [("x", 1, 3, 0), ("x", 2, 3, 1), ("y", 1, 1, 1), ("z", 9, 8, 1), ("y", 2, 9, None)]
    kept = kept_crawls(spark, str(tmp_path / "crawls"))
    for rows in (early, early + late):
        history = DatedHistory(lambda a, b, rows=rows: crawled(*rows), lambda raw: raw, "update_date")
        state = kept.update(history, date(2024, 1, 12))
        assert rows_of(state) == rows_of(newest_crawls(crawled(*rows)))
    prices = spark.createDataFrame([("x",), ("y",)], "competitor string")
    found = {(r.competitor, r.product_id): r.sale_or_not for r in crawl_status(crawled(*early, *late), prices).collect()}
    assert found == {("x", 1): 0, ("x", 2): 0, ("y", 1): 1, ("y", 2): 1}


def test_guard_and_prices_from_kept_tables(raw_tables, spark, tmp_path):
    tables = Tables(spark, root=raw_tables)
    states = {
        "stock_state": kept_stock(spark, str(tmp_path / "stock")),
        "crawl_state": kept_crawls(spark, str(tmp_path / "crawls")),
    }
    Inputs.from_tables(tables, RUN_DATE - timedelta(days=7), SHOP, **states)
    plain = Inputs.from_tables(tables, RUN_DATE, SHOP)
    kept = Inputs.from_tables(tables, RUN_DATE, SHOP, **states)
    assert rows_of(kept.crawls) == rows_of(plain.crawls)
    staging = Staging(spark)
    found = [Signals(spark, i, SHOP, RUN_DATE, staging=staging).pinned_in_stock for i in (plain, kept)]
    staging.drop()
    assert found[0] == found[1]
    assert isinstance(states["stock_state"], KeptNewest)
    read = {f.split("/")[-2] for f in kept.newest_stock.inputFiles()}
    assert len(read) == 1 and read.pop().startswith("version=")


def pushed(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return " ".join(re.findall(r"PushedFilters: \[(.*?)\]", plan))


def test_day_limits_reach_the_scan(raw_tables, spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    inputs = Inputs.from_tables(Tables(spark, root=raw_tables), RUN_DATE, SHOP)
    assert "GreaterThanOrEqual(timestamp,9" in pushed(inputs.stock.since(RUN_DATE))
    assert "GreaterThanOrEqual(timestamp,9" in pushed(inputs.searches.since(RUN_DATE))
    assert "GreaterThanOrEqual(timestamp,9" in pushed(inputs.reviews.since(RUN_DATE))
    assert "GreaterThanOrEqual(timestamp,ScalarSubquery" in pushed(inputs.stock.newest())
    assert "GreaterThanOrEqual(purchased_at,1999-08-01" in pushed(inputs.sales)
    newest = {r.day for r in inputs.stock.newest().select("day").distinct().collect()}
    assert newest == {RUN_DATE}
    recent = inputs.stock.since(RUN_DATE - timedelta(days=2)).select("day").distinct()
    assert {r.day for r in recent.collect()} == {RUN_DATE - timedelta(days=n) for n in range(3)}


def test_day_limits_leave_out_folders(raw_tables, spark, tmp_path):
    plain = Tables(spark, root=raw_tables)
    utc_day = F.date_from_unix_date(F.floor(F.col("timestamp") / 86400).cast("int"))
    layout = {"sales": ("sold_day", F.to_date("purchased_at")), "stock": ("day", utc_day)}
    for name, (column, day) in layout.items():
        frame = plain.load(name).withColumn(column, day).filter(F.col(column) >= "2001-07-20")
        frame.write.partitionBy(column).parquet(f"{tmp_path}/{name}")
    columns = {name: column for name, (column, _) in layout.items()}
    tables = Tables(spark, root=str(tmp_path), day_columns=columns)
    sales = tables.load("sales", RUN_DATE - timedelta(days=2), RUN_DATE)
    assert sales.columns == plain.load("sales").columns
    assert "PartitionFilters: [isnotnull(sold_day" in sales._jdf.queryExecution().toString()
    days = {r.d for r in sales.select(F.to_date("purchased_at").alias("d")).distinct().collect()}
    assert days == {RUN_DATE - timedelta(days=n) for n in range(3)}
    stock = EpochHistory(
        lambda since: tables.load("stock", since), lambda raw: stock_history(raw, 14), 14
    )
    whole = Inputs.from_tables(plain, RUN_DATE, SHOP).stock
    for n in (0, 3):
        since = RUN_DATE - timedelta(days=n)
        assert rows_of(stock.since(since)) == rows_of(whole.since(since))
    assert rows_of(stock.newest()) == rows_of(whole.newest())


def test_newest_day_is_known_by_the_newest_folder(raw_tables, spark, tmp_path):
    plain = Tables(spark, root=raw_tables)
    utc_day = F.date_from_unix_date(F.floor(F.col("timestamp") / 86400).cast("int"))
    layout = {
        "stock": ("day", utc_day),
        "exposures": ("shown_day", F.to_date("date")),
        "competitor_prices": ("date", F.col("date")),
    }
    for name, (column, day) in layout.items():
        frame = plain.load(name).withColumn(column, day).filter(F.col(column) >= "2001-06-20")
        frame.repartition(1).write.partitionBy(column).parquet(f"{tmp_path}/{name}")
    for name in ("item_prices", "items", "crawls", "sales", "products", "feature_values", "variant_names", "option_inventory"):
        plain.load(name).write.parquet(f"{tmp_path}/{name}")
    columns = {name: column for name, (column, _) in layout.items()}
    tables = Tables(spark, root=str(tmp_path), day_columns=columns)
    assert plain.days("stock") == [] and plain.newest("stock") is None
    assert tables.days("stock") == sorted(tables.days("stock"), reverse=True)
    inputs, whole = Inputs.from_tables(tables, RUN_DATE, SHOP), Inputs.from_tables(plain, RUN_DATE, SHOP)
    newest = inputs.stock.newest()
    assert rows_of(newest) == rows_of(whole.stock.newest())
    # A shifted day lies in two folders.
    folders = [d.isoformat() for d in tables.days("stock")]
    assert folders_read(newest, "day") <= set(folders[:2])
    shown = inputs.exposures.newest()
    assert rows_of(shown) == rows_of(whole.exposures.newest()) != []
    assert folders_read(shown, "shown_day") == {tables.days("exposures")[0].isoformat()}
    a, b = tables.days("exposures")[3], tables.days("exposures")[1]
    between = inputs.exposures.between(a, b)
    assert rows_of(between) == rows_of(whole.exposures.all().filter(within(F.col("day"), a, b)))
    assert len(folders_read(between, "shown_day")) == 3
    assert rows_of(inputs.exposures.since(a)) == rows_of(whole.exposures.since(a))
    assert rows_of(inputs.competitor_prices) == rows_of(whole.competitor_prices) != []
    assert folders_read(tables.newest("competitor_prices"), "date") == {tables.days("competitor_prices")[0].isoformat()}
    # Folders without rows, and rows without a day, are passed over.
    plain.load("exposures").limit(0).write.parquet(f"{tmp_path}/exposures/shown_day=2030-01-01")
    plain.load("exposures").limit(3).write.parquet(f"{tmp_path}/exposures/shown_day=__HIVE_DEFAULT_PARTITION__")
    assert tables.days("exposures")[0] == date(2030, 1, 1)
    assert rows_of(inputs.exposures.newest()) == rows_of(whole.exposures.newest())


def folders_read(df, column):
    """The day folders that the scans of a plan open."""
    rows = df.select(F.input_file_name().alias("f")).distinct().collect()
    return {re.search(rf"{column}=([-\d]+)", r.f).group(1) for r in rows}


def test_lists_do_not_overlap(spark, sf_dir):
    signals = Run(spark, sf_dir).signals()
    lists = exclusive_lists(
        signals, repurchase_options={"min_turnover": 2, **REPURCHASE_OPTIONS}
    )
    placed = {r.product_id for r in lists.ranking.filter("rank <= 15").collect()}
    again = {r.product_id for r in lists.repurchase.collect()}
    grown = {r.product_id for r in lists.growth.collect()}
    assert placed and again and grown
    assert not placed & again and not placed & grown and not again & grown


def rows_of(df):
    columns = sorted(df.columns)
    return sorted(str([r[c] for c in columns]) for r in df.collect())


def test_same_list_for_any_partitioning_and_order(spark, sf_dir):
    found = []
    try:
        for partitions, order in (("1", None), ("8", "product_qty"), ("200", "barcode")):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            signals = Run(spark, sf_dir).signals()
            if order:
                shuffled = signals.inputs.sales.repartition(13).sortWithinPartitions(order)
                signals.inputs = replace(signals.inputs, sales=shuffled)
            found.append(rows_of(growth_list(signals)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1] == found[2]


# --- the pinned product -----------------------------------------------------------------


def small_shop(spark, *, pinned_amount, pinned_sells=0):
    """Twenty products that sell alike, and a pinned one that sells little or nothing."""
    day = date(2024, 3, 31)
    sales = [
        (p, u, day - timedelta(days=n), 10.0 + p)
        for p in range(1, 21)
        for u in range(2)
        for n in range(3)
    ]
    sales += [(314, 1, day - timedelta(days=60), 1.0)]
    sales += [(314, 1, day, float(pinned_sells))] if pinned_sells else []
    lines = spark.createDataFrame(
        sales, "product_id bigint, user_id bigint, purchased_at date, product_qty double"
    ).withColumns(
        {
            "barcode": F.col("product_id").cast("string"),
            "variant_name": F.lit("v"),
            "product_name": F.concat(F.lit("name "), F.col("product_id")),
            "category_m": F.lit("c"),
            "category_s": F.lit("s"),
        }
    )
    stock = spark.createDataFrame(
        [(str(p), 5, day) for p in range(1, 21)] + [("314", pinned_amount, day)],
        "barcode string, amount bigint, day date",
    ).withColumn("recorded_at", F.col("day").cast("timestamp"))

    def empty(schema):
        return spark.createDataFrame([], schema)

    inputs = Inputs(
        sales=lines,
        stock=DayHistory(stock),
        option_inventory=lines.select("product_id", "barcode"),
        products=empty("product_id bigint, status string"),
        brands=empty("product_id bigint, brand string"),
        exposures=empty("product_id bigint, day date, popularity double, main_rec_category string"),
        reviews=DayHistory(
            empty(
                "product_id bigint, post_id bigint, rating_value bigint, message string, "
                "post_day date"
            ),
            "post_day",
        ),
        searches=DayHistory(empty("idx bigint, product_id bigint, day date")),
        own_prices=empty("product_id bigint, price_own double"),
        competitor_prices=empty(
            "date date, competitor string, product_id bigint, krw_price double, usd_price double"
        ),
        crawls=empty("competitor string, product_id bigint, sale_or_not bigint"),
    )
    return Signals(spark, inputs, ShopConfig(excluded_categories=()), day)


def growth_zone(signals, lists, **options):
    placed = placement_list(signals, lists, **options).filter(
        F.col("main_rec_category") == GROWTH_ZONE
    )
    return [r.product_id for r in placed.orderBy("location").collect()]


def test_pinned_product_in_stock_takes_the_first_place(spark):
    signals = small_shop(spark, pinned_amount=3)
    lists = exclusive_lists(signals)
    assert lists.pin
    assert growth_zone(signals, lists) == [314, *range(20, 6, -1)]
    # It has days in stock, so it is in the growth list, and is moved to its head.
    listed = [r.product_id for r in lists.growth.orderBy("rank").collect()]
    assert listed == [314, *range(20, 0, -1)]
    assert growth_zone(signals, lists, exclusive=True) == [314, *range(20, 6, -1)]


def test_pinned_product_sold_out_is_nowhere(spark):
    signals = small_shop(spark, pinned_amount=0)
    lists = exclusive_lists(signals)
    assert not lists.pin
    assert growth_zone(signals, lists) == list(range(20, 5, -1))
    assert lists.growth.filter("product_id = 314").isEmpty()


def test_pinned_product_already_placed_stays_there(spark):
    signals = small_shop(spark, pinned_amount=3, pinned_sells=900)
    lists = exclusive_lists(signals)
    assert not lists.pin
    zone = growth_zone(signals, lists)
    assert zone[0] == 314 and len(zone) == 15


def test_pin_without_any_growth(spark):
    signals = small_shop(spark, pinned_amount=3)
    none = exclusive_lists(signals)
    bare = ListRun(
        none.ranking, none.repurchase, none.growth.limit(0), none.growth_top.limit(0), True
    )
    assert growth_zone(signals, bare) == [314]


# --- the library itself -----------------------------------------------------------------


def test_no_rows_pass_through_the_driver():
    banned = r"\.collect\(|\.toPandas\(|\.toLocalIterator\(|localCheckpoint|\.crossJoin\(|\.rdd\b"
    for path in LIBRARY.rglob("*.py"):
        assert not re.search(banned, path.read_text()), path


@pytest.mark.parametrize("master", ["local[8]", "yarn", None])
def test_staging_needs_a_shared_folder(master):
    class Session:
        conf = {"spark.master": master} if master else {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        Staging(Session())
    Session.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert Staging(Session()).path.startswith("hdfs:///shared/shelfpulse-")


def test_library_names_no_local_folder():
    for file in LIBRARY.rglob("*.py"):
        if "llm" not in file.parts:
            assert "tempfile" not in file.read_text(), file


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cards_are_one_aggregate(spark):
    parts = [
        spark.range(9).selectExpr("id AS product_id", f"id * {n} AS v{n}").filter(f"id % {n} = 0")
        for n in (1, 2, 3)
    ]
    cards = side_by_side(parts)
    plan = plan_of(cards).partition("Initial Plan")[2] or plan_of(cards)
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") <= 1
    found = {r.product_id: (r.v1, r.v2, r.v3) for r in cards.collect()}
    assert found[6] == (6, 12, 18) and found[4] == (4, 8, None) and found[1] == (1, None, None)


def test_order_lines_are_read_for_two_frames_only(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # paths are cut off otherwise
    signals = Run(spark, sf_dir).signals_from_tables()
    assert not signals.options.isEmpty() and not signals.daily.isEmpty()
    reading = {name for name, plan in signals._plans.items() if "/raw/sales" in plan_of(plan())}
    assert reading == {"purchase_totals"}


def test_raw_tables_join_lines_and_orders_once(spark, tmp_path):
    """Orders that occur twice, lines without an order and nulls; rows are those of the views."""
    lines = [(k, n, 60 * n + k, k + n, 1.0 * n, 10.0 * k, 0.1, date(1998, 1, k)) for k in (1, 2, 3, 9) for n in (1, 2)]
    lines += [lines[0], (None, 1, 5, 1, 1.0, 1.0, 0.0, None), (2, 3, None, None, None, None, None, None)]
    orders = [(k, 7 * k, date(2001, 5, k)) for k in (1, 2, 3, 3)] + [(None, 1, None)]
    events = [(i, kind, 1.5 * i, f'{{"k": {i}}}', datetime(2024, 1, 5)) for i in (1, 2) for kind in ("view", "click", "purchase")]
    made = {
        "lineitem": (lines, "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity double, "
            "l_extendedprice double, l_discount double, l_shipdate date"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate date"),
        "events": (events, "event_id long, event_type string, value double, props string, ts timestamp"),
    }
    for name, (rows, kinds) in made.items():
        spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # paths are cut off otherwise
    run = Run(spark, str(tmp_path))
    run.from_tables()
    for name in ("fx_sales", "fx_status", "fx_feature", "fx_variant", "fx_names", "fx_threads", "fx_item"):
        plan = plan_of(run.fx[name])
        assert "/raw/sales" in plan and "Join" not in plan, name
    for name, frame in raw_frames(Fixtures(spark, str(tmp_path))).items():
        written = spark.read.parquet(f"{run.staging.path}/raw/{name}")
        assert written.dtypes == frame.dtypes, name
        assert sorted(map(str, written.collect())) == sorted(map(str, frame.collect())), name
    run.staging.drop()


def test_crawl_history_is_reduced_before_it_is_shuffled(raw_tables, spark):
    tables = Tables(spark, root=raw_tables)
    plan = plan_of(crawl_status(tables.load("crawls"), tables.load("competitor_prices")))
    assert re.search(r"HashAggregate\(keys=\[competitor#\d+, product_id#\d+L\], functions=\[partial_max", plan)


def test_databases_are_read_in_splits(spark):
    tables = Tables(spark, jdbc={"url": "jdbc:x"}, splits={"sales": ("order_id", 1, 900, 8)})
    options = tables.jdbc_options("sales")
    assert options["dbtable"] == "sales" and options["numPartitions"] == "8"
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"]) == ("order_id", "1", "900")
    with pytest.raises(ValueError, match="stock"):
        tables.load("stock")


def test_competitors_come_from_the_shop():
    shop = ShopConfig(excluded_categories=(), competitors=("One", "Two", "Three", "Four", "Five"))
    columns = list(with_competitors(GROWTH_COLUMNS, shop.competitors))
    place = columns.index("PRICE_MZ")
    assert columns[place + 1 : place + 6] == [f"PRICE_{n}" for n in ("ONE", "TWO", "THREE", "FOUR", "FIVE")]


def test_excluded_categories_have_to_be_named():
    with pytest.raises(TypeError):
        ShopConfig()
    assert ShopConfig(excluded_categories=(), bypass_products=(7,)).exempt_products == [314, 7]
