"""Loads that are empty, repeated, corrected or broken off, and the marts behind them."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from test_frames import bars, day, dkey, weather
from tickerlake.operators import ledger, moments
from tickerlake.operators.upsert import one_per_key, upsert
from tickerlake.plans import features, templates, warehouse
from tickerlake.plans.incremental import load_dim_weather, load_fact
from tickerlake.plans.store import HALO, MarketStore
from tickerlake.sources import raw
from tickerlake.streaming.daily_upsert import stock_fact_stream, weather_dim_stream

KEY = ["stock_key", "date_key"]


class Stop(Exception):
    pass


def fact(spark, rows):
    """rows: (stock, day index, close)."""
    return spark.createDataFrame(
        [(dkey(d), k, c, c, c, c, 1) for k, d, c in rows],
        "date_key int, stock_key long, open_price double, high_price double, low_price double, "
        "close_price double, volume long")


def closes(df):
    return sorted((r.stock_key, r.date_key, r.close_price) for r in df.collect())


def test_empty_first_load(spark, tmp_dir):
    """A load without rows leaves no table behind, and later loads work."""
    path = f"{tmp_dir}/fact"
    for _ in range(2):
        out = upsert(spark, fact(spark, []), path, KEY)
        assert out.collect() == [] and "close_price" in out.columns
        assert ledger.read_table(spark, path) is None
    assert closes(upsert(spark, fact(spark, [(1, 0, 5.0)]), path, KEY)) == [(1, dkey(0), 5.0)]
    assert closes(upsert(spark, fact(spark, []), path, KEY)) == [(1, dkey(0), 5.0)]
    # the same through the model's loads
    none = bars(spark, [])
    assert load_fact(spark, none, f"{tmp_dir}/d", f"{tmp_dir}/f").collect() == []
    got = load_fact(spark, bars(spark, [("A", 0, 1.0, 1.0, 1.0, 1.0, 1)]), f"{tmp_dir}/d", f"{tmp_dir}/f")
    assert closes(got) == [(1, dkey(0), 1.0)]
    w = raw.raw_weather(weather(spark, []))
    assert load_dim_weather(spark, w, f"{tmp_dir}/w").collect() == []


def test_empty_first_micro_batch(spark, tmp_dir):
    """Files whose rows are all filtered, then files with rows, in both streams."""
    def stocks():
        stock_fact_stream(spark, f"{tmp_dir}/s", f"{tmp_dir}/dim", f"{tmp_dir}/fact",
                          f"{tmp_dir}/c1").awaitTermination()

    def cities():
        weather_dim_stream(spark, f"{tmp_dir}/w", f"{tmp_dir}/cities", f"{tmp_dir}/c2").awaitTermination()

    undated = F.lit(None).cast("date")
    bars(spark, [("A", 0, 1.0, 1.0, 1.0, 1.0, 1)]).withColumn("datetime", undated).write.parquet(
        f"{tmp_dir}/s/part=1")
    weather(spark, [(0, "X", 1.0, 0.0, 0.0)]).withColumn("date", undated).write.parquet(f"{tmp_dir}/w/part=1")
    stocks(), cities()
    assert ledger.read_table(spark, f"{tmp_dir}/fact") is None
    assert ledger.read_table(spark, f"{tmp_dir}/cities") is None
    bars(spark, [("A", 0, 1.0, 1.0, 1.0, 1.0, 1)]).write.parquet(f"{tmp_dir}/s/part=2")
    weather(spark, [(0, "X", 1.0, 0.0, 0.0)]).write.parquet(f"{tmp_dir}/w/part=2")
    stocks(), cities()
    assert spark.read.parquet(f"{tmp_dir}/fact").count() == 1
    assert spark.read.parquet(f"{tmp_dir}/cities").count() == 1


def test_the_later_record_wins(spark, tmp_dir):
    """A correction to a smaller price: in one load by the load sequence, in a later load."""
    rows = bars(spark, [("A", 0, 1.0, 100.0, 1.0, 100.0, 1), ("A", 0, 1.0, 90.0, 1.0, 90.0, 1),
                        ("A", 1, 7.0, 7.0, 7.0, 7.0, 1)])
    seq = rows.withColumn(raw.LOAD_SEQ, F.when(F.col("close") == 100.0, 1).otherwise(2))
    got = load_fact(spark, seq, f"{tmp_dir}/d", f"{tmp_dir}/f")
    assert closes(got) == [(1, dkey(0), 90.0), (1, dkey(1), 7.0)]
    assert raw.LOAD_SEQ not in got.columns
    later = bars(spark, [("A", 1, 7.0, 7.0, 3.0, 3.0, 1)])
    got = load_fact(spark, later, f"{tmp_dir}/d", f"{tmp_dir}/f", lookback_days=5)
    assert closes(got) == [(1, dkey(0), 90.0), (1, dkey(1), 3.0)]
    # without a sequence, or where it ties, the largest by the columns
    tied = fact(spark, [(1, 0, 90.0), (1, 0, 100.0)])
    assert closes(one_per_key(tied, KEY)) == [(1, dkey(0), 100.0)]
    assert closes(one_per_key(tied.withColumn("s", F.lit(1)), KEY, ["s"]).drop("s")) == [(1, dkey(0), 100.0)]


def test_the_file_written_last_wins(spark, tmp_dir):
    def write(name, close, place=1):
        bars(spark, [("A", 0, 1.0, c, 1.0, c, 1) for c in ([close] if place == 1 else [close, place])]
             ).coalesce(1).write.parquet(f"{tmp_dir}/feed/part={name}")

    write(2, 100.0)
    write(1, 90.0)  # written later, though its name comes first
    feed = raw.read_feed(spark, f"{tmp_dir}/feed", raw.STOCK_SCHEMA, load_seq=True)
    got = load_fact(spark, raw.raw_stocks(feed), f"{tmp_dir}/d", f"{tmp_dir}/f")
    assert closes(got) == [(1, dkey(0), 90.0)]
    stock_fact_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/sd", f"{tmp_dir}/sf", f"{tmp_dir}/c").awaitTermination()
    assert closes(spark.read.parquet(f"{tmp_dir}/sf")) == [(1, dkey(0), 90.0)]
    write(0, 80.0, 70.0)  # both in one file: the last one
    stock_fact_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/sd", f"{tmp_dir}/sf", f"{tmp_dir}/c").awaitTermination()
    assert closes(spark.read.parquet(f"{tmp_dir}/sf")) == [(1, dkey(0), 70.0)]
    w = weather(spark, [(0, "X", 9.0, 0.0, 0.0), (0, "X", 4.0, 0.0, 0.0)]).withColumn(
        raw.LOAD_SEQ, -F.col("max_temp"))
    out = load_dim_weather(spark, raw.raw_weather(w), f"{tmp_dir}/w").collect()
    assert [r.max_temp for r in out] == [4.0]


@pytest.mark.parametrize("moves", [0, 1, 2, 3])
def test_load_that_breaks_off(spark, tmp_dir, monkeypatch, moves):
    """Stopped before the record, after it, and between two months: the next load
    finishes it or starts anew, and nothing of the table is lost."""
    path = f"{tmp_dir}/fact"
    first = [(k, d, float(d)) for k in (1, 2) for d in (0, 20, 40, 70)]
    upsert(spark, fact(spark, first), path, KEY)
    second = [(1, d, 100.0 + d) for d in (20, 40, 70, 75)]
    real, done = ledger.Files.move, []

    def move(self, source, target):
        if len(done) == moves:
            raise Stop
        done.append(target)
        real(self, source, target)

    monkeypatch.setattr(ledger.Files, "move", move)
    with pytest.raises(Stop):  # the first move is the record's
        upsert(spark, fact(spark, second), path, KEY, high_water=False)
    monkeypatch.undo()
    old = {(k, dkey(d)): c for k, d, c in first}
    new = old | {(k, dkey(d)): c for k, d, c in second}
    assert ledger.finish(spark, path) == (moves > 0)
    assert {(k, d): c for k, d, c in closes(spark.read.parquet(path))} == (new if moves else old)
    got = upsert(spark, fact(spark, second), path, KEY, high_water=False)
    assert {(k, d): c for k, d, c in closes(got)} == new
    assert ledger.Files(spark, path).names(f"{path}/_ledger") == []


def test_load_finishes_an_open_one_first(spark, tmp_dir, monkeypatch):
    """The high-water mark of a load is read after an open load is finished."""
    rows = [("A", d, 1.0, 1.0, 1.0, float(d + 1), 1) for d in range(0, 90, 10)]
    args = (f"{tmp_dir}/d", f"{tmp_dir}/f")
    load_fact(spark, bars(spark, rows[:2]), *args)
    real, done = ledger.Files.move, []

    def move(self, source, target):
        if len(done) == 2:
            raise Stop
        done.append(target)
        real(self, source, target)

    monkeypatch.setattr(ledger.Files, "move", move)
    with pytest.raises(Stop):
        load_fact(spark, bars(spark, rows[:8]), *args)
    monkeypatch.undo()
    assert closes(load_fact(spark, bars(spark, rows), *args)) == [
        (1, dkey(d), float(d + 1)) for d in range(0, 90, 10)]


# -- marts that follow -------------------------------------------------------
def whole(store):
    """The features of the stored fact by a full computation."""
    base = features.stock_base(store.fact_stock(), store.table("dim"))
    index = features.index_series(base, chunk_rows=None)
    return features.price_features(base, index, chunk_rows=None)


def near(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return a == b


def assert_same(got, want, keys):
    cols = sorted(want.columns)
    mine = {tuple(r[k] for k in keys): r for r in got.select(*cols).collect()}
    rows = want.select(*cols).collect()
    assert len(mine) == len(rows) == got.count()
    for r in rows:
        own = mine[tuple(r[k] for k in keys)]
        for c in cols:
            assert near(own[c], r[c]), (c, own, r)


def feed_rows(rnd, symbols, first, last, share=0.7):
    out = []
    for s in symbols:
        for d in range(first, last):
            if rnd.random() < share:
                o, c = rnd.uniform(5, 50), rnd.uniform(5, 50)
                out.append((s, d, o, max(o, c) + rnd.random(), min(o, c) - rnd.random(), c, rnd.randint(1, 99)))
    return out


def test_store_follows_loads(spark, tmp_dir):
    """Loads in order, late ones, corrections of stocks and of the benchmark, a new
    stock, a repeated load: features, profile and volatility equal full ones."""
    rnd = random.Random(2)
    store = MarketStore(spark, f"{tmp_dir}/store", chunk_rows=40)
    names = ["A", "B", "SPY"]
    loads = [
        feed_rows(rnd, ["A", "SPY"], 0, 200),
        feed_rows(rnd, names, 200, 230),
        feed_rows(rnd, ["SPARSE"], 0, 230, 0.05),
        feed_rows(rnd, ["A"], 100, 103),  # corrections in the middle
        feed_rows(rnd, ["B"], 150, 215),  # before its first day, and across
        feed_rows(rnd, ["SPY"], 205, 207, 1.0),
        feed_rows(rnd, names, 230, 240) + feed_rows(rnd, ["SPARSE"], 235, 240, 1.0),
    ]
    for k, rows in enumerate(loads):
        store.load(bars(spark, rows))
        if k in (3, 6):
            assert_same(store.price_features(), whole(store), ["stock_key", "date_key"])
    before = sorted(glob.glob(f"{tmp_dir}/store/features/month_key=*/*.parquet"))
    store.load(bars(spark, loads[-1]))  # nothing changes, nothing is written
    assert sorted(glob.glob(f"{tmp_dir}/store/features/month_key=*/*.parquet")) == before
    assert_same(store.price_features(), whole(store), ["stock_key", "date_key"])
    feed = store.fact_stock().join(store.table("dim"), "stock_key").select(
        "symbol", F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("datetime"),
        *[F.col(f"{c}_price").alias(c) for c in ("open", "high", "low", "close")], "volume")
    assert_same(store.symbol_profile(), templates.symbol_profile(feed), ["symbol"])
    assert_same(store.volatility_metrics(), templates.volatility_metrics(feed), ["symbol"])


def test_store_reads_touched_months_only(spark, tmp_dir):
    """A correction reads the months of its halo and those behind it, no others."""
    rnd = random.Random(4)
    store = MarketStore(spark, f"{tmp_dir}/store")
    store.load(bars(spark, feed_rows(rnd, ["A", "SPY"], 0, 400, 1.0)))
    first = spark.createDataFrame([(1, dkey(200))], "stock_key long, first int")
    rows = store.rows_to_read(first, HALO)
    # day 200 is in July 2024; its 49 bars before reach into May
    all_months = {r.month_key for r in store.table("fact").select("month_key").distinct().collect()}
    needed = {m for m in all_months if m >= 202405}
    assert {r.month_key for r in rows.select("month_key").distinct().collect()} == needed
    plan = rows._jdf.queryExecution().executedPlan().toString()
    pruned = [x for x in plan.split("PartitionFilters: [")[1:] if x.startswith("month_key")][0]
    listed = pruned.split("]")[0]
    assert "202405" in listed and not any(str(m) in listed for m in all_months - needed)
    past = rows.filter(F.col("date_key") < dkey(200)).count()
    assert past >= HALO
    carried = rows.select("carried_max", "carried_first").distinct().collect()
    old = store.fact_stock().filter("stock_key = 1 and date_key < 20240501")
    want = old.agg(F.max("close_price"), F.min_by("close_price", "date_key")).first()
    assert [tuple(r) for r in carried] == [tuple(want)]


@pytest.mark.parametrize("step", ["_index", "_features"])
def test_store_load_that_breaks_off(spark, tmp_dir, monkeypatch, step):
    """A load stopped after the fact was switched is applied again from its delta."""
    rnd = random.Random(8)
    store = MarketStore(spark, f"{tmp_dir}/store")
    store.load(bars(spark, feed_rows(rnd, ["A", "SPY"], 0, 90)))
    more = feed_rows(rnd, ["A", "SPY", "B"], 80, 110)

    def stop(*_):
        raise Stop

    monkeypatch.setattr(MarketStore, step, stop)
    with pytest.raises(Stop):
        store.load(bars(spark, more))
    monkeypatch.undo()
    again = MarketStore(spark, f"{tmp_dir}/store")
    again.load(bars(spark, more))  # what it brings is stored already
    assert again.recover() is False
    assert_same(again.price_features(), whole(again), ["stock_key", "date_key"])


def test_store_without_rows(spark, tmp_dir):
    store = MarketStore(spark, f"{tmp_dir}/store")
    store.load(bars(spark, []))
    with pytest.raises(ValueError):
        store.price_features()
    store.load(bars(spark, [("A", 0, 1.0, 1.0, 1.0, 1.0, 1)]))  # and without a benchmark
    row = store.price_features().first()
    assert row.close_price == 1.0 and row.beta_20 is None and row.cumulative_return == 0.0
    assert store.volatility_metrics().first().return_volatility is None


def test_month_states_merge(spark):
    """States of any split of the days merge to the same moments, large values too."""
    rows = [(1, d, 1e9 + d % 3) for d in range(120)] + [(2, 0, 5.0)]
    f = fact(spark, rows).withColumn("open_price", F.col("close_price") * 0.9 + F.col("date_key") % 7)
    dim = spark.createDataFrame([(1, "A"), (2, "B")], "stock_key long, symbol string")
    got = {r.symbol: r for r in moments.volatility_metrics(moments.month_states(f), dim).collect()}
    ret = (F.col("close_price") - F.col("open_price")) / F.col("open_price") * 100
    want = f.groupBy("stock_key").agg(F.stddev_samp(ret).alias("s"), F.avg(ret).alias("m")).collect()
    for r in want:
        own = got["AB"[r.stock_key - 1]]
        assert near(own.return_volatility, r.s) and near(own.avg_daily_return_pct, r.m)


def test_days_given_as_text(spark):
    """An observation whose day is no date is left out, and ends no job."""
    w = raw.raw_weather(weather(spark, [(k, "X", 1.0, 0.0, 0.0) for k in range(3)])).withColumn(
        "raw_date", F.when(F.col("raw_date") == F.lit(day(1)), "31/02/oops").otherwise(
            F.col("raw_date").cast("string")))
    assert sorted(r.date_key for r in warehouse.dim_weather(w).collect()) == [dkey(0), dkey(2)]
