"""Incremental builds of FACT_STOCK and DIM_WEATHER on stored tables.

``incremental_fact`` / ``incremental_dim_weather`` replay two loads of the
feeds -- everything up to a cut-off day, then the full feed -- into fresh
tables under the shared checkpoint folder and return the stored table.  In
the default strict mode the second load only takes days past the stored
maximum, so the result equals a full build whenever no feed row arrives late.
With ``lookback_days`` the second load overlaps stored days, whose rows are
replaced on their key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ledger import finish, read_table
from ..operators.upsert import newer_rows, stable_stock_keys, upsert
from ..session import shared_path
from ..sources.raw import load_order
from . import warehouse
from .store import MarketStore

# Fixed value: cut-off day of the first replayed load.
FIRST_LOAD_UNTIL = "1998-06-01"


def load_fact(spark, raw_stocks: DataFrame, dim_path: str, fact_path: str,
              lookback_days: int | None = None) -> DataFrame:
    """One incremental load of the stock fact (stable stock keys, keyed upsert).
    The feed is cut at the high-water mark by its own date, and once; of bars
    with one key the last by the feed's load sequence is loaded, if it has one."""
    finish(spark, fact_path)  # before its high-water mark is read
    new = newer_rows(raw_stocks, "datetime", read_table(spark, fact_path), lookback_days)
    dim = stable_stock_keys(spark, new, dim_path)
    seq = load_order(new)
    return upsert(spark, warehouse.fact_stock(new, dim, seq), fact_path,
                  ["stock_key", "date_key"], high_water=False, load_order=seq)


def load_dim_weather(spark, raw_weather: DataFrame, path: str,
                     lookback_days: int | None = None) -> DataFrame:
    finish(spark, path)
    new = newer_rows(raw_weather, "raw_date", read_table(spark, path), lookback_days)
    seq = load_order(new)
    return upsert(spark, warehouse.dim_weather(new, seq), path, ["city", "date_key"],
                  high_water=False, load_order=seq)


def incremental_fact(build, until: str = FIRST_LOAD_UNTIL, lookback_days: int | None = None) -> DataFrame:
    spark = build.spark
    dim_path = shared_path(spark, "dim_stock")
    fact_path = shared_path(spark, "fact_stock")
    cut = dt.date.fromisoformat(until)
    first = build.raw_stocks.filter(F.to_date("datetime") <= F.lit(cut))
    load_fact(spark, first, dim_path, fact_path, lookback_days)
    return load_fact(spark, build.raw_stocks, dim_path, fact_path, lookback_days)


# Last days of the first and the second of three replayed loads, the
# days of the first whose bars come wrong, and which stocks' they are.
THREE_LOADS_UNTIL = ("1996-12-31", "1998-03-31")
WRONG_DAYS = ("1996-08-05", "1996-08-30")
WRONG_KEYS = 7


def three_loads(build) -> MarketStore:
    """A store after three loads: bars up to a day, some of them wrong; bars up to a
    later day; the rest, and the right ones for the wrong bars."""
    store = MarketStore(build.spark, shared_path(build.spark, "market_store"),
                        chunk_rows=build.chunk_rows)
    feed, day = build.raw_stocks, F.to_date("datetime")
    until = [F.lit(dt.date.fromisoformat(d)) for d in THREE_LOADS_UNTIL]
    start, end = (F.lit(dt.date.fromisoformat(d)) for d in WRONG_DAYS)
    wrong = (
        day.between(start, end) & (F.pmod(F.xxhash64("symbol"), F.lit(WRONG_KEYS)) == 0)
        & (F.col("symbol") != store.benchmark)
    )
    prices = ("open", "high", "low", "close")
    store.load(feed.filter(day <= until[0]).withColumns({
        **{c: F.when(wrong, F.col(c) * 1.25).otherwise(F.col(c)) for c in prices},
        "volume": F.when(wrong, F.col("volume") + 7).otherwise(F.col("volume")),
    }))
    store.load(feed.filter((day > until[0]) & (day <= until[1])))
    store.load(feed.filter((day > until[1]) | wrong))
    return store


def incremental_dim_weather(build, until: str = FIRST_LOAD_UNTIL,
                            lookback_days: int | None = None) -> DataFrame:
    spark = build.spark
    path = shared_path(spark, "dim_weather")
    cut = dt.date.fromisoformat(until)
    first = build.raw_weather.filter(F.col("raw_date") <= F.lit(cut))
    load_dim_weather(spark, first, path, lookback_days)
    return load_dim_weather(spark, build.raw_weather, path, lookback_days)
