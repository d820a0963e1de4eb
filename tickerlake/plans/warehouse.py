"""Warehouse layer: dimensions, the stock fact and the daily bridges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_key, weather_key
from ..operators.row_number import dense_keys, global_row_number

DIM_WEATHER_COLS = [
    "weather_key",
    "date_key",
    "city",
    "appt_max",
    "appt_min",
    "appt_temp_range",
    "max_temp",
    "min_temp",
    "precip",
    "max_wind",
    "sunrise",
    "sunset",
    "daylight_duration",
    "temp_range_c",
]

FACT_COLS = ["date_key", "stock_key", "open_price", "high_price", "low_price", "close_price", "volume"]


def dim_stock(raw_stocks: DataFrame) -> DataFrame:
    """One row per symbol; ``stock_key`` = dense rank of the symbol (NULL last)."""
    return dense_keys(raw_stocks, "symbol", "stock_key")


def dim_news(raw_news: DataFrame) -> DataFrame:
    """One row per article with ``news_key`` = row number by id."""
    src = raw_news.filter(F.col("datetime").isNotNull()).select(
        F.col("id").alias("news_id"),
        "category",
        "headline",
        "summary",
        "url",
        "image",
        "source",
        "related",
        date_key("datetime").alias("date_key"),
    )
    numbered = global_row_number(src, ["news_id"], out_col="news_key")
    return numbered.select(
        "news_key", "news_id", "category", "headline", "summary", "url", "image", "source",
        "related", "date_key",
    )


def weather_source(raw_weather: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Observations with a day; a day given as text that is no date counts as none."""
    day = F.col("raw_date")
    if dict(raw_weather.dtypes)["raw_date"] == "string":
        day = F.try_to_date(day)
    return raw_weather.filter(day.isNotNull()).select(
        date_key(day).alias("date_key"),
        "city",
        "appt_max",
        "appt_min",
        "appt_temp_range",
        "max_temp",
        "min_temp",
        "precip",
        "max_wind",
        "sunrise",
        "sunset",
        "daylight_duration",
        "temp_range_c",
        *extra,
    )


def dim_weather(raw_weather: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """One row per (city, day) with a SHA-256 ``weather_key`` (full build);
    ``extra`` columns of the feed go along."""
    src = weather_source(raw_weather, extra)
    return src.select(weather_key("city", "date_key").alias("weather_key"), *src.columns)


def stock_source(raw_stocks: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return raw_stocks.filter(F.col("datetime").isNotNull()).select(
        date_key("datetime").alias("date_key"),
        "symbol",
        F.col("open").alias("open_price"),
        F.col("high").alias("high_price"),
        F.col("low").alias("low_price"),
        F.col("close").alias("close_price"),
        "volume",
        *extra,
    )


def fact_stock(raw_stocks: DataFrame, dim: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Daily bars keyed by (stock_key, date_key) (full build).

    The dimension has one row per symbol; AQE turns the join into a
    broadcast at run time when the dimension is small, and keeps a shuffle
    join otherwise.
    """
    src = stock_source(raw_stocks, extra)
    return src.join(dim.select("stock_key", "symbol"), "symbol").select(*FACT_COLS, *extra)


def bridge_daily_news(raw_news: DataFrame, dim: DataFrame) -> DataFrame:
    """(date_key, news_key) for every article of DIM_NEWS that the feed has.

    The join is on the article id, so articles without an id have no row.  It
    is a semi join: with unique ids (a tested source contract) that is the
    inner join, and where ids repeat it stays at one row per dimension row
    instead of one per pair of copies.
    """
    ids = raw_news.filter(F.col("datetime").isNotNull()).select(F.col("id").alias("news_id"))
    return dim.join(ids, "news_id", "left_semi").select("date_key", "news_key")


def bridge_daily_weather(raw_weather: DataFrame, dim: DataFrame) -> DataFrame:
    """(date_key, weather_key) for every dimension row whose city and day the
    feed has (a semi join, as above); rows without a city have none."""
    seen = weather_source(raw_weather).select("city", "date_key")
    return dim.join(seen, ["city", "date_key"], "left_semi").select("date_key", "weather_key")
