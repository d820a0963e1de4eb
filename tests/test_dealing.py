"""Shuffles and sorts of large inputs: rows are dealt once, and into tasks of bounded size."""

import datetime as dt

from pyspark.sql import functions as F

from tickerlake.operators import bitmaps, dealing
from tickerlake.plans import features, templates
from tickerlake.sources import fixtures

LINES = ("datetime date, l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, "
         "l_extendedprice double, l_quantity double")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def lines(spark):
    day = dt.date(1996, 1, 5)
    return spark.createDataFrame([
        (day, 1, 1, 7, 10, 5.0, 2.0),
        (day, 2, 1, 7, 11, 9.0, 1.0), (day, 1, 2, 8, 11, 3.0, 4.0), (day, 1, 2, 8, 11, 3.0, 4.0),
        (day, None, 1, 7, 12, 4.0, None), (day, 5, 1, 7, 12, None, 1.0),
        (None, 3, 1, 7, None, 6.0, 1.0), (day, 3, 2, 7, None, None, 1.0),
    ], LINES)


def test_lines_cross_the_network_raw_and_once(spark):
    plan = plan_of(fixtures._supplier_bars(lines(spark)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Aggregate" not in plan.split("Exchange hashpartitioning")[1]


def test_bars_of_one_and_of_several_lines(spark):
    bars = fixtures._whole_bars(fixtures._supplier_bars(lines(spark)))
    got = {(r["l_suppkey"], r["datetime"] is None): (
        r["first_line"]["l_extendedprice"], r["high"], r["low"], r["last_line"]["l_extendedprice"], r["qty"])
        for r in bars.collect()}
    assert got == {
        (10, False): (5.0, 5.0, 5.0, 5.0, 2.0),
        (11, False): (3.0, 9.0, 3.0, 9.0, 9.0),
        (12, False): (4.0, 4.0, 4.0, None, 1.0),  # a null order key comes first
        (None, True): (6.0, 6.0, 6.0, 6.0, 1.0),
        (None, False): (None, None, None, None, 1.0),
    }


def test_tasks_stay_bounded_as_the_input_grows(spark, tmp_path, monkeypatch):
    spark.range(20_000).select("id", F.rand(1).alias("x")).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealing.dealt(stored, "id")._jdf.queryExecution().sparkPlan().toString().count(
        "hashpartitioning(id#") == 1
    monkeypatch.setattr(dealing, "BYTES_PER_TASK", 2_000)
    many = dealing.dealt(stored, "id")
    assert many.rdd.getNumPartitions() > session
    assert many.count() == 20_000


def test_bitmaps_are_made_after_the_shuffle(spark):
    rows = spark.createDataFrame([(1, 5), (1, 5), (1, None), (2, 40_000)], "date_key int, k long")
    made = bitmaps.key_bitmaps(rows, ["date_key"], "k")
    assert "bitmap_construct_agg" not in plan_of(made).split("Exchange hashpartitioning")[1]
    assert {(r.date_key, r.distinct_keys) for r in bitmaps.distinct_keys(made, ["date_key"]).collect()} == {
        (1, 1), (2, 1)}


def test_bars_are_dealt_once_for_count_and_news(spark):
    day = dt.date(1996, 1, 5)
    bars = spark.createDataFrame(
        [("A", day, 1.0, 2.0, 1.0, 2.0, 3)] * 2 + [("B", day, 1.0, 2.0, 1.0, 2.0, 3), (None, day, *[None] * 5)],
        "symbol string, datetime date, open double, high double, low double, close double, volume long")
    news = spark.createDataFrame(
        [(1, "h", dt.datetime(1996, 1, 5), "c", "A")],
        "id long, headline string, datetime timestamp, category string, related string")
    daily = templates.daily_stocks(bars, news)
    scans_of_bars = plan_of(daily).split("volume#")
    assert sum("Exchange hashpartitioning(symbol" in s for s in scans_of_bars) == 1
    got = {(r.symbol, r.news_article_count, tuple(r.headlines)) for r in daily.collect()}
    assert got == {("A", 2, ("h", "h")), ("B", 0, ()), (None, 0, ())}
    assert daily.count() == 3


def test_stored_features_leave_out_what_a_row_tells(spark, tmp_path):
    base = spark.createDataFrame(
        [(20240100 + d, 1, "A", 10.0 + d % 3, 11.0 - d % 4, 12.0, 9.0, 5 + d, None if d == 2 else 0.1, 3.0)
         for d in range(1, 29)],
        "date_key int, stock_key long, symbol string, open_price double, close_price double, "
        "high_price double, low_price double, volume long, daily_return double, price_range double")
    base = base.withColumns({"daily_return": features.daily_return(), "price_range": features.price_range()})
    index = spark.createDataFrame(
        [], "date_key int, index_return double, index_var_20 double, index_rolling_return_20 double")
    whole = features.price_features(base, index, chunk_rows=None)
    assert whole.columns == features.PRICE_FEATURE_COLS
    whole.select(*features.PRICE_STORED_COLS).write.parquet(str(tmp_path / "f"))
    again = features.with_derived(spark.read.parquet(str(tmp_path / "f")))
    assert sorted(map(str, again.collect())) == sorted(map(str, whole.collect()))
    assert {r.trend_direction for r in again.collect()} >= {"Uptrend", "Downtrend"}


def test_store_writes_features_once_and_only_what_is_made(spark, tmp_path, monkeypatch):
    """A load stages no features besides the months it puts in place, and reads no feature by key."""
    from tickerlake.plans import store as stores

    merged = []
    merge = stores.merge
    monkeypatch.setattr(stores, "merge", lambda s, b, path, key: (merged.append(path), merge(s, b, path, key)))
    store = stores.MarketStore(spark, str(tmp_path / "store"))

    def bars(days, price):
        return spark.createDataFrame(
            [(s, dt.date(2024, m, d), price, price + 1, price - 1, price, 10 + d) for s in ("SPY", "A", "B")
             for m, d in days], "symbol string, datetime date, open double, high double, low double, "
                                "close double, volume long")

    store.load(bars([(1, d) for d in range(1, 25)], 5.0))
    store.load(bars([(2, 1)], 6.0).unionByName(bars([(1, 10)], 7.0).filter("symbol = 'A'")))
    assert not any(path.endswith("/features") for path in merged)
    stored = store.table("features")
    assert set(features.DERIVED_COLS).isdisjoint(stored.columns)
    assert stored.groupBy("stock_key", "date_key").count().filter("count > 1").isEmpty()
    base = features.stock_base(store.fact_stock(), store.table("dim"))
    full = features.price_features(base, features.index_series(base, chunk_rows=None), chunk_rows=None)
    same = lambda df: sorted(map(str, df.collect()))
    assert same(store.price_features()) == same(full)


def test_frames_dealt_alike_meet_without_a_shuffle(spark):
    def rows(n, value):
        return spark.range(n).select(
            F.when(F.col("id") % 11 > 0, F.col("id") % 11 - 5).alias("stock_key"),
            (F.col("id") % 7).cast("int").alias("date_key"), F.col("id").alias(value))

    left, right = rows(200, "a"), rows(90, "b")
    dealt = [dealing.dealt_to(df, "stock_key", 5) for df in (left, right)]
    joined = dealt[0].join(dealt[1].hint("merge"), [dealing.SLOT, "stock_key", "date_key"], "left")
    assert plan_of(joined).count("Exchange") == 2
    want = left.join(right, ["stock_key", "date_key"], "left")
    assert sorted(map(str, joined.drop(dealing.SLOT).select(*want.columns).collect())) == sorted(
        map(str, want.collect()))
    at = dealt[0].select("stock_key", dealing.SLOT, F.spark_partition_id().alias("p")).distinct().collect()
    assert len(at) == 11 and all(r[dealing.SLOT] == r.p for r in at) and dealt[0].rdd.getNumPartitions() == 5


def test_slots_grow_with_the_tables(spark, tmp_path, monkeypatch):
    spark.range(20_000).select("id", F.rand(1).alias("x")).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealing.slots(stored) == session
    monkeypatch.setattr(dealing, "BYTES_PER_SLOT", 2_000)
    assert dealing.slots(stored) > session
