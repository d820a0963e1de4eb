"""Model-training feature table: stock x city x day rows.

Stock features (lags, full-window rolling means / std of close, next-day
target) are computed per stock series before the fan-out to cities, weather
changes per city series, and news counts on the one-row-per-day series, so
every shift looks at the previous row of the *same* series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import full_rolling, ordered, safe_div, trailing
from ..operators import series
from ..operators.dealing import dealt, sent_if_small

# Output columns of the training table, in order.
ML_COLS = [
    "date_key", "stock_key", "symbol", "city", "next_day_return", "daily_return",
    "return_lag_1", "return_lag_3", "return_lag_5", "ma_5", "ma_20", "vol_20",
    "avg_temp", "temp_change", "humidity", "humidity_change", "wind_speed", "precipitation",
    "cloud_cover", "weather_condition", "news_count", "news_count_lag_1", "news_count_lag_3",
    "news_count_roll_5", "return_x_temp", "return_x_news", "vol_x_news",
]


def stock_ml(fact: DataFrame, dim_stock: DataFrame,
             chunk_rows: int | None = series.DEFAULT_CHUNK_ROWS,
             largest: int | None = None) -> DataFrame:
    s = dealt(fact, "stock_key").join(dim_stock.select("stock_key", "symbol"), "stock_key", "left").select(
        "date_key",
        "stock_key",
        "symbol",
        "close_price",
        safe_div(F.col("close_price") - F.col("open_price"), "open_price").alias("daily_return"),
    )
    sr = series.prepare(s, "stock_key", back=19, forward=1, chunk_rows=chunk_rows,
                        largest=largest)
    P, O = sr.part, sr.order
    w = ordered(P, O)
    close = F.col("close_price")
    out = sr.df.select(
        "*",
        F.lag("daily_return", 1).over(w).alias("return_lag_1"),
        F.lag("daily_return", 3).over(w).alias("return_lag_3"),
        F.lag("daily_return", 5).over(w).alias("return_lag_5"),
        full_rolling(F.avg(close), close, trailing(P, 4, O), 5).alias("ma_5"),
        full_rolling(F.avg(close), close, trailing(P, 19, O), 20).alias("ma_20"),
        full_rolling(F.stddev_samp(close), close, trailing(P, 19, O), 20).alias("vol_20"),
        F.lead("daily_return", 1).over(w).alias("next_day_return"),
    )
    return sr.own(out).select(
        "date_key", "stock_key", "symbol", "daily_return", "return_lag_1", "return_lag_3",
        "return_lag_5", "ma_5", "ma_20", "vol_20", "next_day_return",
    )


def weather_ml(bridge_weather: DataFrame, dim_weather: DataFrame,
               chunk_rows: int | None = series.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Weather features by (city, day).  Humidity, cloud cover and condition
    are not in the weather feed and stay typed NULL columns."""
    d = dim_weather.drop("date_key")
    j = bridge_weather.join(d, "weather_key", "left")
    avg_temp = (F.col("max_temp") + F.col("min_temp")) / 2
    base = j.select("date_key", "city", avg_temp.alias("avg_temp"), "max_wind", "precip")
    sr = series.prepare(base, "city", back=1, chunk_rows=chunk_rows)
    before = F.lag("avg_temp", 1).over(ordered(sr.part, sr.order))
    return sr.own(sr.df.withColumn("temp_change", F.col("avg_temp") - before)).select(
        "date_key",
        "city",
        "avg_temp",
        "temp_change",
        F.lit(None).cast("double").alias("humidity"),
        F.lit(None).cast("double").alias("humidity_change"),
        F.col("max_wind").alias("wind_speed"),
        F.col("precip").alias("precipitation"),
        F.lit(None).cast("double").alias("cloud_cover"),
        F.lit(None).cast("string").alias("weather_condition"),
    )


def news_ml(bridge_news: DataFrame) -> DataFrame:
    """Articles per day and its lags / 5-day mean.

    The series has one row per calendar day, so its unpartitioned window is
    bounded by the number of days, not by the number of articles.
    """
    daily = bridge_news.groupBy("date_key").agg(F.count(F.lit(1)).alias("news_count"))
    w = Window.orderBy("date_key")
    n = F.col("news_count")
    return daily.select(
        "date_key",
        "news_count",
        F.lag(n, 1).over(w).alias("news_count_lag_1"),
        F.lag(n, 3).over(w).alias("news_count_lag_3"),
        full_rolling(F.avg(n), n, w.rowsBetween(-4, Window.currentRow), 5).alias(
            "news_count_roll_5"
        ),
    )


def ml_features(
    fact: DataFrame,
    dim_stock: DataFrame,
    bridge_weather: DataFrame,
    dim_weather: DataFrame,
    bridge_news: DataFrame,
    chunk_rows: int | None = series.DEFAULT_CHUNK_ROWS,
    largest: int | None = None,
) -> DataFrame:
    stock = stock_ml(fact, dim_stock, chunk_rows=chunk_rows, largest=largest)
    weather = weather_ml(bridge_weather, dim_weather, chunk_rows)
    news = news_ml(bridge_news)
    # bounded by the calendar: the stock rows stay where their windows left them, else
    # they'd be dealt by day, and their tasks be as many and as uneven as days are
    weather, news = sent_if_small(weather), sent_if_small(news)
    j = stock.join(weather, "date_key", "left").join(news, "date_key", "left")
    return j.select(
        "*",
        (F.col("daily_return") * F.col("avg_temp")).alias("return_x_temp"),
        (F.col("daily_return") * F.col("news_count")).alias("return_x_news"),
        (F.col("vol_20") * F.col("news_count")).alias("vol_x_news"),
    ).select(*ML_COLS)
