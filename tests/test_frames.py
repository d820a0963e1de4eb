"""Hand-checked micro frames (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickerlake.plans.build import Build
from tickerlake.sources.raw import NEWS_SCHEMA, STOCK_SCHEMA, WEATHER_FEED_SCHEMA

D0 = dt.date(2024, 1, 1)


def day(i):
    return D0 + dt.timedelta(days=i)


def dkey(i):
    d = day(i)
    return d.year * 10000 + d.month * 100 + d.day


def bars(spark, rows):
    """rows: (symbol, day index, open, high, low, close, volume)."""
    return spark.createDataFrame(
        [(s, day(i), o, h, lo, c, v) for s, i, o, h, lo, c, v in rows], STOCK_SCHEMA
    )


def news(spark, rows):
    """rows: (id, headline, day index, category, related)."""
    return spark.createDataFrame(
        [
            (i, h, dt.datetime.combine(day(d), dt.time(12)), c, "src", r, "s", "u", None)
            for i, h, d, c, r in rows
        ],
        NEWS_SCHEMA,
    )


def weather(spark, rows):
    """rows: (day index, city, max_temp, min_temp, precip)."""
    return spark.createDataFrame(
        [
            (day(d), c, mx, mn, p, 10.0, mx - 1, mn - 2, 1.0, mx - mn, 43200.0, 0, 0)
            for d, c, mx, mn, p in rows
        ],
        WEATHER_FEED_SCHEMA,
    )


def build(spark, stocks=None, news_rows=None, weather_rows=None, **options):
    src = {
        "stocks": bars(spark, stocks or []),
        "news": news(spark, news_rows or []),
        "weather": weather(spark, weather_rows or []),
    }
    return Build(spark, None, sources=src, materialize=False, **options)


def series(symbol, closes, start=0, spread=1.0):
    return [(symbol, start + i, c, c + spread, c - spread, c, 100 + i) for i, c in enumerate(closes)]


def collect(df, order=("symbol", "date_key")):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def test_f1_single_day(spark):
    b = build(spark, stocks=[("AAA", 0, 10.0, 11.0, 9.0, 10.5, 5)])
    (r,) = collect(b.daily_stock_analysis_wide())
    assert r["ma_5"] == r["ma_20"] == r["ma_50"] == 10.5
    assert r["vol_20"] is None and r["sharpe_20"] is None and r["beta_20"] is None
    assert r["rsi_14"] == 100.0
    assert r["drawdown"] == 0.0 and r["cumulative_return"] == 0.0
    assert r["rolling_return_20"] is None
    assert r["trend_direction"] == "Sideways"


def test_f2_rising(spark):
    closes = [10.0 + i for i in range(60)]
    b = build(spark, stocks=series("AAA", closes))
    rows = collect(b.stock_performance())
    assert all(r["rsi_14"] == 100.0 for r in rows)
    assert [r["trend_direction"] for r in rows[:5]] == ["Sideways"] * 5
    assert all(r["trend_direction"] == "Uptrend" for r in rows[5:])
    risk = collect(b.stock_risk())
    assert all(r["drawdown"] == 0.0 for r in risk)
    # rolling return needs 20 earlier rows
    assert rows[19]["rolling_return_20"] is None
    assert rows[20]["rolling_return_20"] == pytest.approx(closes[20] / closes[0] - 1)


def test_f3_falling(spark):
    closes = [100.0 - i for i in range(30)]
    b = build(spark, stocks=series("AAA", closes))
    rows = collect(b.stock_risk())
    assert rows[0]["rsi_14"] == 100.0
    assert all(r["rsi_14"] < 100 for r in rows[1:])
    assert all(r["drawdown"] < 0 for r in rows[1:])
    perf = collect(b.stock_performance())
    assert all(r["trend_direction"] == "Downtrend" for r in perf[5:])


def test_f4_benchmark_gap_and_isolation(spark):
    rows = []
    for i in range(25):
        rows.append(("AAA", i, 10.0, 12.0, 9.0, 10.0 + (i % 3), 10))
        rows.append(("BBB", i, 20.0, 22.0, 19.0, 20.0 - (i % 4), 10))
        if i != 10:  # benchmark missing on day 10
            rows.append(("SPY", i, 50.0, 52.0, 49.0, 50.0 + (i % 5), 10))
    b = build(spark, stocks=rows)
    risk = collect(b.stock_risk())
    perf = {(r["symbol"], r["date_key"]): r for r in collect(b.stock_performance())}
    gap = [r for r in risk if r["date_key"] == dkey(10)]
    assert all(r["index_return"] is None and r["beta_20"] is None for r in gap)
    assert all(perf[(r["symbol"], dkey(10))]["index_rolling_return_20"] is None for r in gap)
    # the benchmark against itself: beta 1 where its variance is positive
    spy = [r for r in risk if r["symbol"] == "SPY" and r["beta_20"] is not None]
    assert spy and all(r["beta_20"] == pytest.approx(1.0) for r in spy)
    # per-symbol windows: AAA's ma_5 only sees AAA closes
    aaa = [r for r in risk if r["symbol"] == "AAA"]
    assert aaa[4]["ma_5"] == pytest.approx(sum(10.0 + (i % 3) for i in range(5)) / 5)
    # benchmark stats on its own series: 20 benchmark days, skipping the gap
    idx = {r["date_key"]: r for r in b.index_series.collect()}
    assert dkey(10) not in idx and len(idx) == 24


def test_f5_news_zscore_frame_is_21_rows(spark):
    counts = [1] * 24 + [10]
    news_rows, nid = [], 0
    for d, n in enumerate(counts):
        for _ in range(n):
            nid += 1
            news_rows.append((nid, f"h{nid}", d, "c", "AAA"))
    b = build(spark, stocks=series("AAA", [10.0] * 25), news_rows=news_rows)
    rows = collect(b.news_features())
    last = rows[-1]
    frame = counts[-21:]
    mean = sum(frame) / 21
    sd = (sum((x - mean) ** 2 for x in frame) / 20) ** 0.5
    assert last["news_zscore_20"] == pytest.approx((10 - mean) / sd)


def test_f6_constant_news_gives_null(spark):
    news_rows = [(i, f"h{i}", i, "c", "AAA") for i in range(10)]
    b = build(spark, stocks=series("AAA", [10.0 + i for i in range(10)]), news_rows=news_rows)
    rows = collect(b.news_features())
    assert all(r["news_zscore_20"] is None for r in rows)
    assert all(r["vol_news_corr_20"] is None for r in rows)


def test_f7_breakout_inclusive_vs_exclusive(spark):
    rows = [("AAA", i, 10.0, 10.5, 9.5, 10.0, 10) for i in range(20)]
    rows.append(("AAA", 20, 10.0, 12.0, 9.5, 11.5, 10))  # close above prior highs, high >= close
    b = build(spark, stocks=rows)
    inc = collect(b.stock_performance())[-1]
    exc = collect(b.stock_performance(breakout_exclude_current=True))[-1]
    assert inc["breakout_signal"] is False
    assert exc["breakout_signal"] is True
    assert inc["resistance_level"] == 12.0


def test_f8_zero_open(spark):
    b = build(spark, stocks=[("AAA", 0, 0.0, 1.0, 0.0, 1.0, 5), ("AAA", 1, 1.0, 2.0, 1.0, 2.0, 5)])
    rows = collect(b.stock_technical())
    assert rows[0]["daily_return"] is None
    assert rows[1]["daily_return"] == 1.0


def test_f9_quality_counts(spark):
    from tickerlake.operators import quality

    stocks = bars(spark, [
        ("AAA", 0, 1.0, 1.0, 1.0, 1.0, 1),
        ("AAA", 1, 0.0, 1.0, 1.0, 1.0, 1),
        ("AAA", 2, -1.0, 1.0, 1.0, 1.0, 1),
        ("AAA", 3, None, 1.0, 1.0, 1.0, 1),
        (None, 4, 1.0, 1.0, 1.0, 1.0, 0),
    ])
    nw = news(spark, [(1, "a", 0, "c", "AAA"), (1, "b", 0, "c", "AAA"), (None, "c", 0, "c", "AAA"),
                      (2, None, 0, "c", None)])
    rep = quality.quality_report({"raw_news": nw, "raw_stocks": stocks})
    got = {(r.table_name, r.column_name, r.check_name): r.failures for r in rep.collect()}
    assert got[("raw_stocks", "open", "positive")] == 2  # 0 and -1; NULL passes
    assert got[("raw_stocks", "open", "not_null")] == 1
    assert got[("raw_stocks", "symbol", "not_null")] == 1
    assert got[("raw_stocks", "volume", "positive")] == 1
    assert got[("raw_news", "id", "unique")] == 1
    assert got[("raw_news", "id", "not_null")] == 1
    assert got[("raw_news", "headline", "not_null")] == 1
    assert got[("raw_news", "related", "not_null")] == 1
    failing = quality.failing_rows(stocks, quality.Check("raw_stocks", "open", "positive"))
    assert failing.count() == 2


def test_f10_incremental_modes_and_stable_keys(spark, tmp_dir):
    from tickerlake.operators.upsert import stable_stock_keys, upsert
    from tickerlake.plans import warehouse

    first = [("MMM", i, 10.0, 11.0, 9.0, 10.0, 1) for i in range(5)]
    later = [("MMM", i, 10.0, 11.0, 9.0, 10.0, 1) for i in range(5, 8)]
    late_symbol = [("AAA", 2, 5.0, 6.0, 4.0, 5.0, 1)]  # sorts before MMM, arrives late
    correction = [("MMM", 4, 10.0, 11.0, 9.0, 99.0, 1)]  # restates the last loaded day

    def load(rows, lookback=None, tag="t"):
        raw = bars(spark, rows)
        dim = stable_stock_keys(spark, raw, f"{tmp_dir}/{tag}_dim")
        return upsert(spark, warehouse.fact_stock(raw, dim), f"{tmp_dir}/{tag}_fact",
                      ["stock_key", "date_key"], lookback)

    load(first, tag="strict")
    out = load(later + late_symbol + correction, tag="strict")
    keys = {r.symbol: r.stock_key for r in spark.read.parquet(f"{tmp_dir}/strict_dim").collect()}
    assert keys == {"MMM": 1, "AAA": 2}  # existing key kept, new symbol appended
    rows = out.collect()
    assert len(rows) == 8  # late row and correction dropped in strict mode
    assert {r.close_price for r in rows if r.date_key == dkey(4)} == {10.0}

    load(first, tag="lb")
    out = load(later + late_symbol + correction, lookback=3, tag="lb")
    rows = out.collect()
    assert len(rows) == 9  # late row (day 2 >= hwm - 3 days) merged
    assert {r.close_price for r in rows if r.date_key == dkey(4)} == {99.0}


def test_f11_news_arrays(spark):
    news_rows = [(1, None, 0, "x", "AAA"), (2, "b", 0, "x", "AAA"), (3, "a", 0, "y", "AAA")]
    b = build(spark, stocks=[("AAA", 0, 1.0, 1.0, 1.0, 1.0, 1), ("AAA", 1, 1.0, 1.0, 1.0, 1.0, 1)],
              news_rows=news_rows)
    rows = collect(b.daily_stocks, order=("symbol", "trade_date"))
    assert rows[0]["headlines"] == ["a", "b"]
    assert rows[0]["news_categories"] == ["x", "y"]
    assert rows[0]["news_article_count"] == 3
    assert rows[1]["headlines"] == [] and rows[1]["news_categories"] == []
    assert rows[1]["news_article_count"] == 0


def test_f12_ml_fanout_and_target(spark):
    stocks = series("AAA", [10.0, 11.0, 12.0]) + series("BBB", [5.0, 4.0, 6.0])
    w = [(d, c, 20.0 + d, 10.0, 0.0) for d in range(3) for c in ("X", "Y")]
    b = build(spark, stocks=stocks, weather_rows=w)
    rows = collect(b.ml_features(), order=("symbol", "date_key", "city"))
    assert len(rows) == 6 * 2
    aaa_x = [r for r in rows if r["symbol"] == "AAA" and r["city"] == "X"]
    rets = [0.0, 0.0, 0.0]  # open == close in `series`
    assert [r["next_day_return"] for r in aaa_x] == [rets[1], rets[2], None]
    assert all(r["ma_5"] is None and r["vol_20"] is None for r in rows)
    assert [r["temp_change"] for r in aaa_x] == [None, 0.5, 0.5]  # avg of max+1 and min


def test_f13_weather_day_without_market(spark):
    b = build(spark, stocks=[("AAA", 0, 1.0, 2.0, 0.5, 1.5, 10)],
              weather_rows=[(0, "X", 20.0, 10.0, 1.0), (1, "X", 21.0, 11.0, 0.0)])
    rows = collect(b.weather_market_conditions, order=("trade_date",))
    assert rows[0]["stocks_tracked"] == 1 and rows[0]["stocks_up"] == 1
    empty = rows[1]
    assert empty["stocks_tracked"] == 0
    assert empty["stocks_up"] == empty["stocks_down"] == empty["stocks_flat"] == 0
    assert empty["avg_pct_change"] is None and empty["total_market_volume"] is None


def test_f11b_identical_bars_count_every_copy(spark):
    bar = ("AAA", 0, 1.0, 2.0, 0.5, 1.5, 10)
    b = build(spark, stocks=[bar, bar], news_rows=[(1, "a", 0, "x", "AAA"), (2, "b", 0, "x", "AAA")])
    (r,) = collect(b.daily_stocks, order=("symbol",))
    assert r["news_article_count"] == 4  # copies x articles, as the grouped join counts
    assert r["headlines"] == ["a", "a", "b", "b"]  # and as it lists them
    assert r["news_categories"] == ["x"]


def test_f11c_bridges_drop_rows_without_a_key(spark):
    news_rows = [(1, "a", 0, "x", "AAA"), (None, "b", 0, "x", "AAA"), (3, "c", 1, "x", "AAA")]
    b = build(spark, stocks=[("AAA", 0, 1.0, 1.0, 1.0, 1.0, 1)], news_rows=news_rows,
              weather_rows=[(0, "X", 20.0, 10.0, 0.0), (1, None, 20.0, 10.0, 0.0),
                            (2, "X", 20.0, 10.0, 0.0)])
    assert b.dim_news.count() == 3 and b.bridge_daily_news.count() == 2
    assert b.dim_weather.count() == 3 and b.bridge_daily_weather.count() == 2


@pytest.mark.parametrize("chunk", [7, 50])
def test_repeated_bars_do_not_depend_on_chunks(spark, chunk):
    """Two bars a day: windows follow one total order whatever the chunk size."""
    rows = [("AAA", d, 10.0 + d % 5, 12.0 + d % 5 + k, 9.0, 10.0 + (d * 7 + k * 3) % 4, 1 + k + d)
            for d in range(40) for k in range(2)]
    news_rows = [(d * 2 + k, f"h{d}", d, "x", "AAA") for d in range(40) for k in range(1 + d % 3)]
    made = {}
    for size in (None, chunk):
        b = build(spark, stocks=rows, news_rows=news_rows,
                  weather_rows=[(d, "X", 20.0 + d % 3, 10.0, 0.0) for d in range(40) for _ in (0, 1)],
                  chunk_rows=size)
        made[size] = [sorted(map(str, t.collect())) for t in (
            b.daily_stock_analysis_wide(), b.news_features(), b.ml_features())]
    assert made[None] == made[chunk]


def test_f10b_one_row_per_key_and_day_files(spark, tmp_dir):
    """A repeated key is loaded once; a second file of a stored day is merged; a
    replayed batch changes nothing."""
    from tickerlake.operators.upsert import stable_stock_keys, upsert
    from tickerlake.plans import warehouse

    def load(rows):
        raw = bars(spark, rows)
        dim = stable_stock_keys(spark, raw, f"{tmp_dir}/dim")
        out = upsert(spark, warehouse.fact_stock(raw, dim), f"{tmp_dir}/fact",
                     ["stock_key", "date_key"], high_water=False)
        return sorted((r.stock_key, r.date_key, r.close_price) for r in out.collect())

    aapl = [("AAPL", 0, 1.0, 2.0, 1.0, 1.5, 1), ("AAPL", 0, 1.0, 2.0, 1.0, 1.75, 1)]
    assert load(aapl) == [(1, dkey(0), 1.75)]
    msft = [("MSFT", 0, 3.0, 3.0, 3.0, 3.0, 1), ("MSFT", 0, 3.0, 3.0, 3.0, 2.0, 1)]
    both = [(1, dkey(0), 1.75), (2, dkey(0), 3.0)]
    assert load(msft) == both
    assert load(msft) == both
    assert load([("AAPL", 0, 9.0, 9.0, 9.0, 9.0, 9)]) == [(1, dkey(0), 9.0), both[1]]


def test_f10c_unreadable_target_is_an_error(spark, tmp_dir):
    import os

    from tickerlake.operators.ledger import read_table

    assert read_table(spark, f"{tmp_dir}/nowhere") is None
    os.makedirs(f"{tmp_dir}/empty")
    assert read_table(spark, f"{tmp_dir}/empty") is None  # no file, no row
    os.makedirs(f"{tmp_dir}/broken")
    with open(f"{tmp_dir}/broken/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        read_table(spark, f"{tmp_dir}/broken")


def test_f10d_high_water_mark_reaches_the_scan(spark, tmp_dir):
    from tickerlake.operators.upsert import newer_rows

    bars(spark, [("AAA", d, 1.0, 1.0, 1.0, 1.0, 1) for d in range(9)]).write.parquet(f"{tmp_dir}/feed")
    feed = spark.read.parquet(f"{tmp_dir}/feed")
    target = spark.createDataFrame([(dkey(4),)], "date_key int")
    new = newer_rows(feed, "datetime", target)
    assert new.count() == 4 and newer_rows(feed, "datetime", target, 2).count() == 7
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(datetime" in plan


def test_contract_passes_nan_and_large_values(spark):
    from tickerlake.contract import contract_round

    vals = [float("nan"), 1e15, -3e14, float("inf"), 1.234564, 1.234566]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vals)], "k int, v double")
    got = [r.x for r in df.orderBy("k").select(contract_round(F.col("v")).alias("x")).collect()]
    assert got[0] != got[0] and got[1:] == [1e15, -3e14, float("inf"), 1.23456, 1.23457]


def test_cluster_without_shared_folder_is_an_error():
    from types import SimpleNamespace

    from tickerlake.session import ensure_checkpoint_dir

    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None,
                         getConf=lambda: SimpleNamespace(get=lambda k, d=None: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_planted_orphan_is_counted(spark):
    from tickerlake.operators import quality

    b = build(spark, stocks=[("AAA", 0, 1.0, 1.0, 1.0, 1.0, 1)],
              news_rows=[(1, "a", 0, "x", "AAA"), (2, "b", 0, "x", "ZZZ"), (3, "c", 0, "x", None)])
    (r,) = quality.relationship_report(
        [("raw_news", b.raw_news, "related", b.dim_stock, "symbol")]).collect()
    assert r.failures == 1


def test_f9b_grain_check(spark):
    from tickerlake.operators import quality

    stocks = bars(spark, [("AAA", 0, 1.0, 1.0, 1.0, 1.0, 1), ("AAA", 0, 2.0, 2.0, 2.0, 2.0, 1),
                          ("AAA", 1, 1.0, 1.0, 1.0, 1.0, 1), (None, 2, 1.0, 1.0, 1.0, 1.0, 1),
                          (None, 2, 1.0, 1.0, 1.0, 1.0, 1)])
    rep = quality.grain_report([("raw_stocks", stocks, ["symbol", "datetime"])]).first()
    assert rep.failures == 2  # (AAA, day 0) and (NULL, day 2)
