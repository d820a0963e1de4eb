"""Moments per stock and month that merge into those of any longer span.

A state holds counts, sums, extremes and, of the daily return, mean and squared
deviations (M2).  States of a month are replaced when a load changes the month;
a stock's profile and volatility are merged from its states, so no bar of an
unchanged month is read again.  Squared deviations merge as
``sum(M2) + sum(n * (mean - overall mean) ** 2)``: nothing is subtracted from a
large sum, so nothing cancels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import key_to_date, pct, safe_div
from .ledger import PART_COL


def month_states(fact: DataFrame) -> DataFrame:
    """One row per stock and month of a fact with one bar per stock and day."""
    bars = fact.withColumns({
        PART_COL: (F.col("date_key") / 100).cast("int"),
        "change": F.col("close_price") - F.col("open_price"),
        "spread": F.col("high_price") - F.col("low_price"),
    }).withColumn("ret", pct("change", "open_price"))
    return bars.groupBy("stock_key", PART_COL).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date_key").alias("first_day"),
        F.max("date_key").alias("last_day"),
        F.min_by("close_price", "date_key").alias("first_close"),
        F.max("close_price").alias("max_close"),
        F.max("high_price").alias("max_high"),
        F.min("low_price").alias("min_low"),
        F.count("close_price").alias("close_n"),
        F.sum("close_price").alias("close_sum"),
        F.count("volume").alias("volume_n"),
        F.sum("volume").alias("volume_sum"),
        F.count("spread").alias("spread_n"),
        F.sum("spread").alias("spread_sum"),
        F.count("ret").alias("ret_n"),
        F.avg("ret").alias("ret_mean"),
        (F.var_pop("ret") * F.count("ret")).alias("ret_m2"),
        F.count_if(F.col("change") > 0).alias("up"),
        F.count_if(F.col("change") < 0).alias("down"),
    )


def _mean(sum_: str, n: str) -> Column:
    return safe_div(F.sum(sum_).cast("double"), F.sum(n))


def symbol_profile(states: DataFrame, dim: DataFrame) -> DataFrame:
    """One row per symbol: date range, day count, extremes, averages."""
    return states.groupBy("stock_key").agg(
        key_to_date(F.min("first_day")).alias("first_seen_date"),
        key_to_date(F.max("last_day")).alias("last_seen_date"),
        F.sum("n").alias("total_trading_days"),
        F.max("max_high").alias("all_time_high"),
        F.min("min_low").alias("all_time_low"),
        _mean("close_sum", "close_n").alias("avg_close_price"),
        _mean("volume_sum", "volume_n").alias("avg_daily_volume"),
    ).join(dim.select("stock_key", "symbol"), "stock_key").drop("stock_key")


def volatility_metrics(states: DataFrame, dim: DataFrame) -> DataFrame:
    """Per-symbol volatility and volume summary over all months."""
    whole = Window.partitionBy("stock_key")  # a stock's months: bounded by the calendar
    mean = safe_div(F.sum(F.col("ret_mean") * F.col("ret_n")).over(whole),
                    F.sum("ret_n").over(whole))
    s = states.withColumn("mean", mean)
    apart = F.col("ret_mean") - F.col("mean")
    m2 = F.sum(F.col("ret_m2") + F.col("ret_n") * apart * apart)
    return s.groupBy("stock_key").agg(
        F.sum("n").alias("trading_days"),
        key_to_date(F.min("first_day")).alias("first_trade_date"),
        key_to_date(F.max("last_day")).alias("last_trade_date"),
        F.max("max_high").alias("period_high"),
        F.min("min_low").alias("period_low"),
        _mean("close_sum", "close_n").alias("avg_close"),
        _mean("volume_sum", "volume_n").alias("avg_daily_volume"),
        F.sum("volume_sum").alias("total_volume"),
        _mean("spread_sum", "spread_n").alias("avg_daily_range"),
        # one return has no deviation
        F.sqrt(safe_div(m2, F.nullif(F.sum("ret_n") - 1, F.lit(0)))).alias("return_volatility"),
        F.max("mean").alias("avg_daily_return_pct"),
        F.sum("up").alias("up_days"),
        F.sum("down").alias("down_days"),
    ).join(dim.select("stock_key", "symbol"), "stock_key").drop("stock_key")
