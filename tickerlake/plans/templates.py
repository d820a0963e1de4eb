"""Symbol / city profiles, daily facts with news, and the two market marts.

These are the template models of the original project (symbol profile, city
climate, daily stocks with their news, daily weather, stock-news mart,
weather-market mart, per-symbol volatility).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import direction, exact_avg, pct, round_half_up
from ..operators.dealing import dealt

DAILY_STOCK_KEYS = ["symbol", "trade_date", "open", "high", "low", "close", "volume"]


def with_trade_date(raw_stocks: DataFrame) -> DataFrame:
    return raw_stocks.withColumn("trade_date", F.to_date("datetime"))


def symbol_profile(raw_stocks: DataFrame) -> DataFrame:
    """One row per symbol: date range, day count, extremes, averages."""
    s = with_trade_date(raw_stocks)
    return s.groupBy("symbol").agg(
        F.min("trade_date").alias("first_seen_date"),
        F.max("trade_date").alias("last_seen_date"),
        F.count(F.lit(1)).alias("total_trading_days"),
        F.max("high").alias("all_time_high"),
        F.min("low").alias("all_time_low"),
        F.avg("close").alias("avg_close_price"),
        F.avg("volume").alias("avg_daily_volume"),
    )


def city_climate(raw_weather: DataFrame) -> DataFrame:
    """One row per city: observation range and typical / extreme conditions."""
    return raw_weather.groupBy("city").agg(
        F.min("raw_date").alias("first_observation_date"),
        F.max("raw_date").alias("last_observation_date"),
        F.count(F.lit(1)).alias("total_observation_days"),
        round_half_up(exact_avg("max_temp"), 2).alias("avg_max_temp"),
        round_half_up(exact_avg("min_temp"), 2).alias("avg_min_temp"),
        round_half_up(exact_avg("precip"), 2).alias("avg_daily_precip"),
        round_half_up(exact_avg("max_wind"), 2).alias("avg_max_wind"),
        F.max("max_temp").alias("hottest_day_temp"),
        F.min("min_temp").alias("coldest_day_temp"),
        F.max("precip").alias("wettest_day_precip"),
    )


def daily_weather(raw_weather: DataFrame) -> DataFrame:
    return raw_weather.select(
        F.col("raw_date").alias("date"), "city", "max_temp", "min_temp", "precip", "max_wind"
    )


def news_by_symbol_day(raw_news: DataFrame, lists: bool = True) -> DataFrame:
    """Articles per (related symbol, publish day): count, headlines, categories.

    Aggregated before the join with the bars so that each bar meets one row
    per day instead of every article.
    """
    n = raw_news.filter(F.col("related").isNotNull() & F.col("datetime").isNotNull())
    collected = [
        F.collect_list("headline").alias("n_headlines"),
        F.collect_set("category").alias("n_categories"),
    ]
    return n.groupBy(
        F.col("related").alias("symbol"), F.to_date("datetime").alias("trade_date")
    ).agg(F.count("id").alias("n_articles"), *(collected if lists else []))


def daily_bars(raw_stocks: DataFrame, raw_news: DataFrame) -> DataFrame:
    """:func:`daily_stocks` without its two lists, for models that only count."""
    return daily_stocks(raw_stocks, raw_news, lists=False)


def daily_stocks(raw_stocks: DataFrame, raw_news: DataFrame, lists: bool = True) -> DataFrame:
    """One row per bar (symbol, day, OHLCV) with range, change, direction and
    the day's news for the symbol.

    Identical bars form one group whose count and headline list hold every
    article once per copy, as a GROUP BY over the bar-article join would.  The
    copies are counted on the bars alone, then each distinct bar meets its day's
    news aggregate once.  Bars are dealt by symbol and day, for the count and the
    join alike; where copies meet in a task, they are counted as they arrive.
    """
    bars = dealt(with_trade_date(raw_stocks).select(*DAILY_STOCK_KEYS), "symbol", "trade_date")
    distinct_bars = bars.groupBy(*DAILY_STOCK_KEYS).agg(F.count(F.lit(1)).alias("copies"))
    news = news_by_symbol_day(raw_news, lists)
    j = distinct_bars.join(news, ["symbol", "trade_date"], "left")
    m = F.col("copies")
    o, c = F.col("open"), F.col("close")
    none = F.array().cast("array<string>")
    news_lists = [
        F.coalesce(F.sort_array("n_categories"), none).alias("news_categories"),
        F.coalesce(
            F.when(m > 1, F.sort_array(F.flatten(F.array_repeat("n_headlines", m.cast("int")))))
            .otherwise(F.sort_array("n_headlines")),
            none,
        ).alias("headlines"),
    ] if lists else []
    return j.select(
        *DAILY_STOCK_KEYS,
        (F.col("high") - F.col("low")).alias("daily_range"),
        (c - o).alias("daily_change"),
        round_half_up(pct(c - o, o), 4).alias("pct_change"),
        direction(o, c).alias("direction"),
        (F.coalesce(F.col("n_articles"), F.lit(0)) * m).cast("long").alias("news_article_count"),
        *news_lists,
    )


def stock_news_daily(daily: DataFrame, profile: DataFrame) -> DataFrame:
    """Daily bars with news plus the symbol's all-time context."""
    p = profile.select("symbol", "all_time_high", "all_time_low", "avg_close_price")
    j = daily.join(p, "symbol", "left")
    return j.select(
        *DAILY_STOCK_KEYS,
        "daily_range",
        "daily_change",
        "pct_change",
        "direction",
        "news_article_count",
        "news_categories",
        "headlines",
        "all_time_high",
        "all_time_low",
        "avg_close_price",
        round_half_up(pct(F.col("close") - F.col("all_time_high"), "all_time_high"), 4).alias(
            "pct_from_ath"
        ),
    )


def market_by_day(daily: DataFrame) -> DataFrame:
    """Market breadth per trading day (one row per day)."""
    d = F.col("direction")
    return daily.groupBy("trade_date").agg(
        F.countDistinct("symbol").alias("stocks_tracked"),
        exact_avg("pct_change").alias("avg_pct_change_raw"),
        exact_avg("daily_range").alias("avg_daily_range_raw"),
        F.sum("volume").alias("volume_sum"),
        F.count_if(d == "UP").alias("up"),
        F.count_if(d == "DOWN").alias("down"),
        F.count_if(d == "FLAT").alias("flat"),
    )


def weather_market_conditions(weather: DataFrame, climate: DataFrame, daily: DataFrame) -> DataFrame:
    """One row per (day, city) observation with that day's market breadth.

    The market is aggregated per day first and joined once per observation,
    instead of joining every bar to every city.  Identical observations form
    one group, whose sums count each copy (``copies``), as in the grouped
    three-way join.
    """
    obs_keys = ["date", "city", "max_temp", "min_temp", "precip", "max_wind"]
    obs = weather.groupBy(*obs_keys).agg(F.count(F.lit(1)).alias("copies"))
    normal = climate.select("city", F.col("avg_max_temp").alias("city_normal_max_temp"))
    market = market_by_day(daily).withColumnRenamed("trade_date", "date")
    j = obs.join(normal, "city", "left").join(market, "date", "left")
    m = F.col("copies")
    return j.select(
        F.col("date").alias("trade_date"),
        "city",
        "max_temp",
        "min_temp",
        "precip",
        "max_wind",
        "city_normal_max_temp",
        (F.col("max_temp") - F.col("city_normal_max_temp")).alias("temp_deviation_from_normal"),
        F.coalesce("stocks_tracked", F.lit(0)).cast("long").alias("stocks_tracked"),
        round_half_up("avg_pct_change_raw", 4).alias("avg_pct_change"),
        round_half_up("avg_daily_range_raw", 4).alias("avg_daily_range"),
        (F.col("volume_sum") * m).cast("long").alias("total_market_volume"),
        F.coalesce(F.col("up") * m, F.lit(0)).cast("long").alias("stocks_up"),
        F.coalesce(F.col("down") * m, F.lit(0)).cast("long").alias("stocks_down"),
        F.coalesce(F.col("flat") * m, F.lit(0)).cast("long").alias("stocks_flat"),
    )


def volatility_metrics(raw_stocks: DataFrame) -> DataFrame:
    """Per-symbol volatility and volume summary over the whole history."""
    s = with_trade_date(raw_stocks).select(
        "symbol",
        "trade_date",
        "high",
        "low",
        "close",
        "volume",
        (F.col("high") - F.col("low")).alias("daily_range"),
        (F.col("close") - F.col("open")).alias("daily_change"),
        pct(F.col("close") - F.col("open"), "open").alias("daily_return_pct"),
    )
    chg = F.col("daily_change")
    return s.groupBy("symbol").agg(
        F.count("trade_date").alias("trading_days"),
        F.min("trade_date").alias("first_trade_date"),
        F.max("trade_date").alias("last_trade_date"),
        F.max("high").alias("period_high"),
        F.min("low").alias("period_low"),
        F.avg("close").alias("avg_close"),
        F.avg("volume").alias("avg_daily_volume"),
        F.sum("volume").alias("total_volume"),
        F.avg("daily_range").alias("avg_daily_range"),
        F.stddev_samp("daily_return_pct").alias("return_volatility"),
        F.avg("daily_return_pct").alias("avg_daily_return_pct"),
        F.count_if(chg > 0).alias("up_days"),
        F.count_if(chg < 0).alias("down_days"),
    )
