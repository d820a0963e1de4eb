"""What queries write and shuffle: each row once where it is needed, not whole tables beside."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickerlake.operators import dealing, kept_top, row_number, upsert
from tickerlake.plans import kept_reports, marts, templates
from tickerlake.plans.build import Build


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def same(df) -> list[str]:
    return sorted(map(str, df.collect()))


@pytest.fixture()
def tables(spark, tmp_path):
    """Orders and lines of 1996: two suppliers, days with and without articles, a bare line."""
    rng, start = random.Random(5), dt.datetime(1996, 4, 20)
    day = lambda: start + dt.timedelta(days=rng.randrange(110))
    lines = [(k // 3, k % 3, k, rng.choice([1, 2]), float(rng.randrange(100, 200)), 1.0 + k % 5, day())
             for k in range(240)]
    lines.append((None, 1, None, None, None, None, start))
    orders = [(k, k % 4, day(), "1-URGENT") for k in range(80)]
    for name, rows, schema in [
        ("lineitem", lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, "
                            "l_extendedprice double, l_quantity double, l_shipdate timestamp"),
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string"),
        ("customer", [(k, f"m{k}") for k in range(3)], "c_custkey long, c_mktsegment string"),
    ]:
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.fixture()
def written(monkeypatch):
    """Names of the tables that builds write."""
    names = []
    table = Build.table
    monkeypatch.setattr(
        Build, "table", lambda self, df, name, day=None: (names.append(name), table(self, df, name, day))[1])
    return names


def test_news_features_write_no_prices_and_no_article_twice(spark, tables, written):
    b = Build(spark, tables)
    got = same(b.news_features())
    assert "price_features" not in written and "dim_news" not in written
    stored = Build(spark, tables)
    stored.price_feature_table  # noqa: B018
    assert "price_features" in written
    assert same(stored.news_features()) == got and len(got) > 20
    assert b.dim_news.agg(F.countDistinct("news_key"), F.max("news_key")).first()[:] == (80, 80)


def test_dim_news_has_a_folder_of_its_own_when_asked(spark, tables, tmp_path, written):
    b = Build(spark, tables, warehouse_dir=str(tmp_path / "wh"))
    assert same(b.dim_news) == same(Build(spark, tables).dim_news)
    assert same(spark.read.parquet(str(tmp_path / "wh/dim_news"))) == same(b.dim_news)
    assert written.count("dim_news") == 1


def test_numbered_rows_are_sorted_in_bounded_tasks():
    assert row_number.BYTES_PER_PARTITION <= dealing.BYTES_PER_TASK


def test_price_marts_make_their_own_columns_only(spark, tables, written):
    b, stored = Build(spark, tables), Build(spark, tables)
    risk, performance = b.stock_risk(), b.stock_performance()
    assert "price_features" not in written
    assert "volume_zscore_20" not in plan_of(risk) and "resistance_level" not in plan_of(risk)
    stored.price_feature_table  # noqa: B018
    assert same(stored.stock_risk()) == same(risk)
    assert same(stored.stock_performance()) == same(performance)
    assert same(stored.stock_technical()) == same(b.stock_technical())
    assert "Window" not in plan_of(stored.stock_risk())  # the table is read where there is one


def test_top_news_makes_the_bars_of_each_load_only(spark, tables, written):
    b = Build(spark, tables)
    got, over_all = same(b.top_news.by_day()), same(b.top_news.over_all())
    assert "daily_bars" not in written
    whole = Build(spark, tables)
    assert whole.daily_bars.filter(F.col("trade_date") < dt.date.fromisoformat(kept_reports.AGAIN_FROM)).count()
    assert same(whole.top_news.by_day()) == got and same(whole.top_news.over_all()) == over_all
    assert sorted(got) == same(kept_top.KeptTop(spark, "unused", 20, [("news_article_count", True)], [
        "symbol", "date_key"]).first(templates.daily_bars(b.raw_stocks, b.raw_news).withColumn(
            "date_key", F.col("trade_date"))).select(*b.top_news.by_day().columns))


def test_lists_go_to_the_load(spark, tmp_path, monkeypatch):
    """A load is not shuffled by its keys to find the few that are listed; null keys replace nothing."""
    plans = []
    stored = kept_top.KeptTop._stored
    monkeypatch.setattr(kept_top.KeptTop, "_stored", lambda self, df, name: (
        plans.append(plan_of(df)), stored(self, df, name))[1])
    top = kept_top.KeptTop(spark, str(tmp_path / "top"), 2, [("n", True)], ["symbol", "date_key"])
    schema = "symbol string, date_key int, n long"
    lists = spark.createDataFrame([("a", 20240101, 9), (None, 20240101, 8)], schema)
    load = spark.createDataFrame([("a", 20240101, 1), (None, 20240101, 7), ("b", 20240101, 3)], schema)
    new, anew = top.certain(lists, load)
    assert any("LeftSemi" in p.split("BroadcastHashJoin", 1)[-1] for p in plans if "LeftAnti" in p)
    assert new.count() == 0 and [r.date_key for r in anew.collect()] == [20240101]


def test_the_feed_is_written_once(spark, tables, written):
    b = Build(spark, tables)
    bars = {(r.symbol, r.datetime): r for r in b.raw_stocks.collect()}
    assert written == []
    lines = [r for r in spark.read.parquet(f"{tables}/lineitem.parquet").collect()]
    assert len(bars) == len({(r.l_suppkey, r.l_shipdate) for r in lines}) + len({r.l_shipdate for r in lines})
    for (symbol, day), bar in bars.items():
        mine = [r for r in lines if r.l_shipdate.date() == day and (
            symbol == "SPY" or symbol == (r.l_suppkey and f"S{r.l_suppkey}"))]
        mine.sort(key=lambda r: (r.l_orderkey is not None, r.l_orderkey, r.l_linenumber))
        prices = [r.l_extendedprice for r in mine if r.l_extendedprice is not None]
        assert (bar.open, bar.close) == (mine[0].l_extendedprice, mine[-1].l_extendedprice)
        assert (bar.high, bar.low) == ((max(prices), min(prices)) if prices else (None, None))


def test_keys_of_new_months_replace_nothing(spark, tmp_path, monkeypatch):
    path, schema, plans = str(tmp_path / "t"), "stock_key long, date_key int, v long", []
    stage = upsert.stage_months
    monkeypatch.setattr(upsert, "stage_months", lambda df, target: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), stage(df, target))[1])
    frame = lambda rows: spark.createDataFrame(rows, schema)
    upsert.merge(spark, frame([(1, 20240101, 1), (2, 20240101, 2), (1, 20231201, 3)]), path, ["stock_key", "date_key"])
    batch = str(tmp_path / "batch")
    frame([(1, 20240101, 5), (1, 20240201, 6), (3, 20240201, 7)]).write.parquet(batch)
    upsert.merge(spark, spark.read.schema(schema).parquet(batch), path, ["stock_key", "date_key"])
    # both months are asked of the table, one alone of the batch's keys
    assert plans[1].count("202401") > plans[1].count("202402") > 0
    got = spark.read.schema(schema).parquet(path).select("stock_key", "date_key", "v").collect()
    assert sorted(map(tuple, got)) == [
        (1, 20231201, 3), (1, 20240101, 5), (1, 20240201, 6), (2, 20240101, 2), (3, 20240201, 7)]


@pytest.fixture()
def unsent(spark):
    """Tables are sent to every task only where the code says so."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def joined_from_tables(b, cols):
    """The scored rows from stored price and news features."""
    return marts.scored(b.price_feature_table, b.news_feature_table).select(*cols)


@pytest.mark.parametrize("name, cols", [
    ("daily_stock_analysis", marts.ANALYSIS_COLS), ("daily_stock_analysis_wide", marts.WIDE_COLS)])
def test_scored_marts_store_no_features_and_deal_bars_once(spark, tables, written, unsent, name, cols):
    b = Build(spark, tables)
    b.index_series = F.broadcast(b.index_series)  # a row per day
    mart = getattr(b, name)()
    got = same(mart)
    assert not {"price_features", "news_features", "scored"} & set(written)
    plan = plan_of(mart).split("Initial Plan")[0]
    assert "hashpartitioning" not in plan  # rows with features stay where they are made
    # bars for prices, the same for news, and news days
    assert plan.count("- Exchange shufflepartitionidpassthrough") == 2 and "ReusedExchange" in plan
    want = joined_from_tables(Build(spark, tables), cols).collect()
    assert got == sorted(map(str, want)) and len(got) > 150
    assert sum(r.vol_news_corr_20 is not None for r in want) > 5


@pytest.mark.parametrize("chunk", [None, 9])
def test_scored_marts_of_repeated_bars_and_foreign_news(spark, chunk):
    """Two bars a day, news of stocks without a bar, of none, on days without a bar."""
    start = dt.date(2024, 1, 1)
    day = lambda d: start + dt.timedelta(days=d)
    bars = [(s, day(d), 10.0 + d % 5, 12.0 + d % 5 + k, 9.0, 10.0 + (d * 7 + k * 3) % 4, 1 + k + d)
            for s in ("AAA", "SPY", None) for d in range(0, 40, 2) for k in range(1 + (s == "AAA"))]
    news = [(n, None, dt.datetime.combine(day(d), dt.time()), "x", "s", who, None, None, None)
            for n, (d, who) in enumerate((d, who) for d in range(40) for who in ("AAA", "ZZZ", None)
                                         for _ in range(1 + d % 3))]
    sources = {
        "stocks": spark.createDataFrame(bars, "symbol string, datetime date, open double, high double, "
                                              "low double, close double, volume long"),
        "news": spark.createDataFrame(news, "id long, headline string, datetime timestamp, category string, "
                                            "source string, related string, summary string, url string, image string"),
    }
    b = Build(spark, "", sources, chunk_rows=chunk)
    b.scored_table  # noqa: B018
    got = same(b.daily_stock_analysis_wide())
    assert "Window" not in plan_of(b.daily_stock_analysis())  # the table is read where there is one
    plain = Build(spark, "", sources, chunk_rows=None)
    assert got == same(joined_from_tables(plain, marts.WIDE_COLS))
    assert len(got) == 20 * 4 + 20  # each bar of a day with each news row of it
