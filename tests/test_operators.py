"""Composed operators: global row number, dense keys, streaming upsert, properties."""

import datetime as dt

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL


def test_global_row_number_matches_window(spark):
    from tickerlake.operators.row_number import global_row_number

    df = spark.range(0, 5000).select(
        (F.col("id") % 97).alias("k"), (F.col("id") * 7 % 13).alias("v"), F.col("id")
    ).union(spark.createDataFrame([(None, 1, 9999)], "k long, v long, id long"))
    got = global_row_number(df, ["k"], num_partitions=7)
    w = Window.orderBy(F.col("k").asc_nulls_last(), F.col("v").asc_nulls_last(),
                       F.col("id").asc_nulls_last())
    want = df.withColumn("want", F.row_number().over(w))
    j = got.join(want.select("id", "want"), "id")
    assert j.count() == 5001
    assert j.filter(F.col("row_number") != F.col("want")).count() == 0
    last = got.filter(F.col("k").isNull()).first()
    assert last.row_number == 5001  # NULL key sorts last


def test_dense_keys(spark):
    from tickerlake.operators.row_number import dense_keys

    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "s string")
    got = {r.s: r.k for r in dense_keys(df, "s", "k", num_partitions=3).collect()}
    assert got == {"a": 1, "b": 2, "c": 3, None: 4}


def test_stream_upsert_equals_batch(spark, tmp_dir):
    from tickerlake.plans.build import Build
    from tickerlake.streaming.daily_upsert import stock_fact_stream

    b = Build(spark, SF_SMALL)
    feed = b.raw_stocks
    cut = dt.date(1998, 6, 1)
    feed.filter(F.col("datetime") <= F.lit(cut)).write.parquet(f"{tmp_dir}/feed/part=1")
    q = stock_fact_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/dim", f"{tmp_dir}/fact",
                          f"{tmp_dir}/ckpt")
    q.awaitTermination()
    feed.filter(F.col("datetime") > F.lit(cut)).write.parquet(f"{tmp_dir}/feed/part=2")
    q = stock_fact_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/dim", f"{tmp_dir}/fact",
                          f"{tmp_dir}/ckpt")
    q.awaitTermination()
    cols = ["date_key", "stock_key", "open_price", "high_price", "low_price", "close_price",
            "volume"]
    streamed = spark.read.parquet(f"{tmp_dir}/fact").select(*cols)
    full = b.fact_stock.select(*cols)
    assert streamed.count() == full.count()
    assert streamed.exceptAll(full).count() == 0


def test_analysis_properties(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    bad = df.filter(
        (F.col("score") < 0) | (F.col("score") > 100) | (F.col("score") % 5 != 0)
        | (F.col("rsi_14") < 0) | (F.col("rsi_14") > 100)
        | (F.col("drawdown") > 0)
        | (F.col("support_level") > F.col("close_price"))
        | (F.col("close_price") > F.col("resistance_level"))
        | ~F.col("recommendation").isin("BUY", "HOLD", "SELL")
    )
    assert bad.count() == 0


@pytest.mark.parametrize("chunk", [7, 30])
def test_chunked_series_equal_plain(spark, chunk):
    """Forcing tiny chunks (hot-key path) gives exactly the plain windows' rows."""
    from tickerlake.plans import features, ml
    from tickerlake.plans.build import Build

    b = Build(spark, SF_SMALL)
    base, idx = b.stock_base, b.index_series
    i_plain = features.index_series(base, chunk_rows=None)
    i_chunk = features.index_series(base, chunk_rows=chunk)
    assert i_chunk.exceptAll(i_plain).count() == 0 and i_chunk.count() == i_plain.count()
    plain = features.price_features(base, idx, chunk_rows=None)
    chunked = features.price_features(base, idx, chunk_rows=chunk)
    cols = plain.columns
    assert chunked.count() == plain.count()
    assert chunked.select(*cols).exceptAll(plain.select(*cols)).count() == 0
    n_plain = features.news_features(b.dim_news, base, chunk_rows=None)
    n_chunk = features.news_features(b.dim_news, base, chunk_rows=chunk)
    assert n_chunk.exceptAll(n_plain).count() == 0 and n_chunk.count() == n_plain.count()
    m_plain = ml.stock_ml(b.fact_stock, b.dim_stock, chunk_rows=None)
    m_chunk = ml.stock_ml(b.fact_stock, b.dim_stock, chunk_rows=chunk)
    assert m_chunk.exceptAll(m_plain).count() == 0 and m_chunk.count() == m_plain.count()


def test_write_models_roundtrip(spark, tmp_dir):
    from tickerlake.plans.build import Build
    from tickerlake.plans.materialize import write_models

    b = Build(spark, SF_SMALL)
    out = write_models(b, f"{tmp_dir}/wh", names=["fact_stock", "dim_symbols", "daily_stock_analysis"])
    fact = spark.read.parquet(out["fact_stock"])
    assert "month_key" in fact.columns
    assert fact.drop("month_key").exceptAll(b.fact_stock).count() == 0
    assert spark.read.parquet(out["dim_symbols"]).count() == b.symbol_profile.count()
    assert spark.read.parquet(out["daily_stock_analysis"]).count() == b.fact_stock.count()


def test_bridges_follow_the_feed(spark):
    from tickerlake.plans import warehouse
    from tickerlake.plans.build import Build

    b = Build(spark, SF_SMALL)
    assert warehouse.bridge_daily_news(b.raw_news, b.dim_news).count() == b.dim_news.count()
    # a stored dimension with an article no longer in the feed: the semi join drops it
    late = b.raw_news.filter("id % 2 = 0")
    assert warehouse.bridge_daily_news(late, b.dim_news).count() == late.filter(
        "datetime is not null").count()


def test_weather_stream_equals_batch(spark, tmp_dir):
    from tickerlake.plans.build import Build
    from tickerlake.sources import fixtures
    from tickerlake.streaming.daily_upsert import weather_dim_stream

    feed = fixtures.weather_api(spark, SF_SMALL)
    cut = dt.date(1998, 6, 1)
    feed.filter(F.col("date") <= F.lit(cut)).write.parquet(f"{tmp_dir}/feed/part=1")
    weather_dim_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/dim", f"{tmp_dir}/ckpt").awaitTermination()
    feed.filter(F.col("date") > F.lit(cut)).write.parquet(f"{tmp_dir}/feed/part=2")
    weather_dim_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/dim", f"{tmp_dir}/ckpt").awaitTermination()
    full = Build(spark, SF_SMALL, warehouse_dir=f"{tmp_dir}/wh").dim_weather
    streamed = spark.read.parquet(f"{tmp_dir}/dim").select(*full.columns)
    assert streamed.count() == full.count() and streamed.exceptAll(full).count() == 0


def test_build_with_hot_key_chunks_equals_plain(spark):
    """The whole scored mart and the ML table through Build, with every series
    forced into 50-row chunks (the hot-key path), equal the plain build."""
    from tickerlake.plans.build import Build

    plain = Build(spark, SF_SMALL, chunk_rows=None)
    hot = Build(spark, SF_SMALL, chunk_rows=50)
    for name in ("daily_stock_analysis_wide", "ml_features"):
        a, b = getattr(plain, name)(), getattr(hot, name)()
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0, name
