"""Ad-hoc reports over the marts and the raw feeds (the example queries).

Top-k reports order by their measure and then by stable keys, so the k rows
are the same on every run; Spark plans ``orderBy(...).limit(k)`` as a
per-partition top-k followed by a merge of k rows per partition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exact_avg, round_half_up, weather_type

# Default parameters of the example reports.
TOP_K = 20
REPORT_DAY = "1998-06-01"
REPORT_CITY = "ASIA"


def top_news_on_day(stock_news: DataFrame, day: str = REPORT_DAY, k: int = TOP_K) -> DataFrame:
    """Symbols with the most articles on one trading day."""
    d = dt.date.fromisoformat(day)
    if "month_key" in stock_news.columns:  # stored by month: other months' files are skipped
        stock_news = stock_news.filter(F.col("month_key") == d.year * 100 + d.month)
    return (
        stock_news.filter(F.col("trade_date") == F.lit(d))
        .select(
            "symbol",
            "trade_date",
            "close",
            round_half_up("pct_change", 2).alias("pct_change"),
            "news_article_count",
            "headlines",
        )
        .orderBy(F.col("news_article_count").desc_nulls_last(), F.col("symbol").asc_nulls_last())
        .limit(k)
    )


def news_vs_move(stock_news: DataFrame, k: int = TOP_K) -> DataFrame:
    """Average article count against average absolute move, per symbol."""
    return (
        stock_news.groupBy("symbol")
        .agg(
            F.avg("news_article_count").alias("avg_news_count"),
            F.avg(F.abs("pct_change")).alias("avg_abs_pct_change"),
        )
        .orderBy(F.col("avg_abs_pct_change").desc_nulls_last(), F.col("symbol").asc_nulls_last())
        .limit(k)
    )


def weather_type_summary(wmc: DataFrame, city: str = REPORT_CITY) -> DataFrame:
    """Market return and breadth by precipitation bucket in one city."""
    return (
        wmc.filter(F.col("city") == city)
        .withColumn("weather_type", weather_type("precip"))
        .groupBy("city", "weather_type")
        .agg(
            F.count(F.lit(1)).alias("trading_days"),
            round_half_up(exact_avg("avg_pct_change"), 4).alias("avg_market_return_pct"),
            round_half_up(exact_avg("stocks_up"), 0).alias("avg_stocks_up"),
            round_half_up(exact_avg("stocks_down"), 0).alias("avg_stocks_down"),
        )
        .orderBy("weather_type")
    )


def most_volatile(vol: DataFrame, k: int = TOP_K) -> DataFrame:
    """Symbols with the highest return volatility (ordered by the rounded value)."""
    return (
        vol.select(
            "symbol",
            "trading_days",
            "period_high",
            "period_low",
            round_half_up("avg_close", 2).alias("avg_close"),
            round_half_up("return_volatility", 4).alias("return_volatility"),
            round_half_up("avg_daily_return_pct", 4).alias("avg_daily_return_pct"),
            "up_days",
            "down_days",
        )
        .orderBy(F.col("return_volatility").desc_nulls_last(), F.col("symbol").asc_nulls_last())
        .limit(k)
    )


def top_article_counts(daily: DataFrame, k: int = TOP_K) -> DataFrame:
    """Bars with the most same-day articles about their symbol."""
    return (
        daily.select(
            "symbol", "trade_date", "open", "high", "low", "close", "volume",
            "daily_range", "pct_change", "news_article_count",
        )
        .orderBy(
            F.col("news_article_count").desc_nulls_last(),
            *[F.col(c).asc_nulls_last() for c in
              ("symbol", "trade_date", "open", "high", "low", "close", "volume")],
        )
        .limit(k)
    )


def preview(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """First ``n`` rows of a table in a stated order."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table, one row per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def list_tables(spark, database: str | None = None) -> DataFrame:
    """Tables of a catalog database as a DataFrame (name, database, type, temporary)."""
    rows = [
        (t.name, t.database, t.tableType, bool(t.isTemporary))
        for t in spark.catalog.listTables(database)
    ]
    return spark.createDataFrame(
        rows, "name string, database string, table_type string, is_temporary boolean"
    )
