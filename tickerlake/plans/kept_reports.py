"""Reports that are kept instead of recomputed: each day's bars with most articles.

Bars with their article counts are stored by month and merged on (symbol, day); the
lists of the days that a load touches are brought up to date from the lists and the
load (``operators.kept_top``).  The report over all days is read from the lists.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_key
from ..operators.kept_top import DAY, KeptTop
from ..operators.ledger import read_table
from ..operators.upsert import merge
from ..session import shared_path
from . import reports, templates

# Last day of the first load's bars and of its news, first day of the
# second load, which brings the days between anew with all their news.
BARS_UNTIL, NEWS_UNTIL, AGAIN_FROM = "1996-06-30", "1996-06-10", "1996-05-20"
KEY = ["symbol", DAY]
COLUMNS = ["symbol", "trade_date", "open", "high", "low", "close", "volume", "daily_range",
           "pct_change", "news_article_count"]


class TopNews:
    """Bars with article counts and each day's first ``k`` of them, under one folder."""

    def __init__(self, spark: SparkSession, root: str, k: int = reports.TOP_K):
        self.spark, self.root = spark, root.rstrip("/")
        self.top = KeptTop(spark, f"{self.root}/lists", k, [("news_article_count", True)], KEY)

    def load(self, daily: DataFrame) -> int:
        """Load bars (one row per symbol and day, as ``templates.daily_bars``); returns how
        many days were listed anew from the stored bars.  A load that broke off is
        completed by loading it again."""
        batch = shared_path(self.spark, "top_news")
        rows = daily.select(*COLUMNS, date_key("trade_date").alias(DAY))
        rows.write.parquet(batch)
        rows = self.spark.read.schema(rows.schema).parquet(batch)
        merge(self.spark, rows, f"{self.root}/bars", KEY)
        bars = read_table(self.spark, f"{self.root}/bars")
        return 0 if bars is None else self.top.apply(rows, bars)

    def by_day(self) -> DataFrame:
        return self.top.lists().select("trade_date", "symbol", "close", "pct_change", "news_article_count")

    def over_all(self) -> DataFrame:
        return self.top.over_all().select(*COLUMNS)


def two_loads(build) -> TopNews:
    """Bars up to a day, the last of them without all their news; then the rest, and
    the last weeks before that day again."""
    kept = TopNews(build.spark, shared_path(build.spark, "top_news_store"))
    bars, news, again = (F.lit(dt.date.fromisoformat(d)) for d in (BARS_UNTIL, NEWS_UNTIL, AGAIN_FROM))
    day = F.to_date("datetime")
    kept.load(templates.daily_bars(
        build.raw_stocks.filter(day <= bars), build.raw_news.filter(day <= news)))
    # of the rest only its own days are made, unless another mart has stored all
    if "daily_bars" in build.__dict__:
        rest = build.daily_bars.filter(F.col("trade_date") >= again)
    else:
        rest = templates.daily_bars(
            build.raw_stocks.filter(day >= again), build.raw_news.filter(day >= again))
    kept.load(rest)
    return kept
