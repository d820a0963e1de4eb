"""Staging: the raw_news / raw_stocks / raw_weather views.

News and stocks pass through unchanged; weather renames its feed columns and
calls the observation day ``raw_date``.  Readers for stored feeds take an
explicit schema so nothing is inferred at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NEWS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("headline", T.StringType()),
        T.StructField("datetime", T.TimestampType()),
        T.StructField("category", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("related", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("image", T.StringType()),
    ]
)

STOCK_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("datetime", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)

WEATHER_FEED_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("city", T.StringType()),
        T.StructField("max_temp", T.DoubleType()),
        T.StructField("min_temp", T.DoubleType()),
        T.StructField("precip", T.DoubleType()),
        T.StructField("max_wind", T.DoubleType()),
        T.StructField("appt_max", T.DoubleType()),
        T.StructField("appt_min", T.DoubleType()),
        T.StructField("appt_temp_range", T.DoubleType()),
        T.StructField("temp_range_c", T.DoubleType()),
        T.StructField("daylight_duration", T.DoubleType()),
        T.StructField("sunrise", T.LongType()),
        T.StructField("sunset", T.LongType()),
    ]
)

# Feed column -> staging column of the weather view, in order.
WEATHER_RENAMES = [
    ("date", "raw_date"),
    ("city", "city"),
    ("max_temp", "max_temp"),
    ("min_temp", "min_temp"),
    ("precip", "precip"),
    ("max_wind", "max_wind"),
    ("appt_max", "appt_max"),
    ("appt_min", "appt_min"),
    ("appt_temp_range", "appt_temp_range"),
    ("temp_range_c", "temp_range_c"),
    ("daylight_duration", "daylight_duration"),
    ("sunrise", "sunrise"),
    ("sunset", "sunset"),
]


def raw_news(feed: DataFrame) -> DataFrame:
    return feed.select("*")


def raw_stocks(feed: DataFrame) -> DataFrame:
    return feed.select("*")


def raw_weather(feed: DataFrame) -> DataFrame:
    return feed.select(*[feed[src].alias(dst) for src, dst in WEATHER_RENAMES], *load_order(feed))


#: Tells which of two records of a feed came later: the larger one.
LOAD_SEQ = "load_seq"


def load_order(feed: DataFrame) -> list[str]:
    """The load sequence, of feeds that have one."""
    return [LOAD_SEQ] if LOAD_SEQ in feed.columns else []


def with_load_seq(feed: DataFrame, fmt: str = "parquet") -> DataFrame:
    """A feed read from files with its load sequence: when a file was written, its
    name, and in parquet files the row's place in it.  Goes on the reader (or
    stream reader) directly, where the files are still known."""
    place = "_metadata.row_index" if fmt == "parquet" else "cast(0 as bigint)"
    return feed.selectExpr(
        "*", f"struct(_metadata.file_modification_time as written, _metadata.file_path as file, "
             f"{place} as place) as {LOAD_SEQ}")


def read_feed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
              load_seq: bool = False) -> DataFrame:
    """Read a stored feed with a declared schema (parquet, json, csv, orc), with
    its load sequence where that is asked for."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    feed = reader.format(fmt).load(path)
    return with_load_seq(feed, fmt) if load_seq else feed
