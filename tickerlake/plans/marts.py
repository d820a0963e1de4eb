"""The scored daily analysis marts (32-column and 41-column variants)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flag_points
from ..operators.dealing import SLOT
from .features import with_breakout

# Output columns of the analysis tables, in order.
ANALYSIS_COLS = [
    "date_key", "symbol", "open_price", "close_price", "high_price", "low_price", "volume",
    "daily_return", "price_range", "ma_5", "ma_20", "ma_50", "macd_line", "rsi_14", "vol_20",
    "beta_20", "sharpe_20", "drawdown", "resistance_level", "support_level", "breakout_signal",
    "trend_direction", "rolling_return_20", "cumulative_return", "index_rolling_return_20",
    "news_count", "news_zscore_20", "volume_zscore_20", "news_vs_volume_zscore",
    "vol_news_corr_20", "score", "recommendation",
]

WIDE_COLS = [
    "date_key", "stock_key", "symbol", "open_price", "close_price", "high_price", "low_price",
    "volume", "daily_return", "price_range", "ma_5", "ma_20", "ma_50", "vol_20", "ema_12",
    "ema_26", "macd_line", "prev_close", "gain", "loss", "avg_gain", "avg_loss", "rsi_14",
    "index_return", "beta_20", "sharpe_20", "drawdown", "resistance_level", "support_level",
    "breakout_signal", "trend_direction", "rolling_return_20", "cumulative_return",
    "index_rolling_return_20", "news_count", "news_zscore_20", "volume_zscore_20",
    "news_vs_volume_zscore", "vol_news_corr_20", "score", "recommendation",
]


def score(c=F.col) -> Column:
    """0-100 composite: nine 10-point signals and two 5-point news signals.
    A NULL input makes its signal 0."""
    # Signal thresholds and points of the score.
    return (
        flag_points(c("trend_direction") == "Uptrend", 10)
        + flag_points(c("close_price") > c("ma_50"), 10)
        + flag_points(c("macd_line") > 0, 10)
        + flag_points(c("rsi_14").between(50, 65), 10)
        + flag_points(c("breakout_signal"), 10)
        + flag_points(c("rolling_return_20") > c("index_rolling_return_20"), 10)
        + flag_points(c("sharpe_20") > 1, 10)
        + flag_points(c("drawdown") > -0.10, 10)
        + flag_points(c("beta_20").between(0, 1.5), 10)
        + flag_points(c("news_zscore_20") > 1, 5)
        + flag_points(c("volume_zscore_20") > 1, 5)
    ).cast("int")


def recommendation(s: Column) -> Column:
    # Label cut-offs.
    return F.when(s >= 70, "BUY").when(s >= 40, "HOLD").otherwise("SELL")


def scored(feats: DataFrame, news: DataFrame, breakout_exclude_current: bool = False) -> DataFrame:
    """Every feature column with score and label, one row per (symbol, day).  Both sides
    have the stock's symbol or key; dealt to slots alike they meet without a shuffle."""
    # the volume z-score comes with the news row (NULL on days without news)
    feats = with_breakout(feats, breakout_exclude_current).drop("volume_zscore_20")
    on = [c for c in (SLOT, "stock_key", "symbol", "date_key")
          if c in feats.columns and c in news.columns]
    if SLOT in on:
        news = news.hint("shuffle_hash")  # the few narrow rows are held, the wide ones not sorted
    merged = feats.join(news, on, "left").drop(SLOT)
    with_score = merged.withColumn("score", score())
    return with_score.withColumn("recommendation", recommendation(F.col("score")))


def daily_stock_analysis(feats: DataFrame, news: DataFrame,
                         breakout_exclude_current: bool = False) -> DataFrame:
    """Technical, risk, performance and news features with score and label.

    Risk and performance are derived from the technical rows of the same
    (symbol, day), so they come from the same feature pass instead of being
    joined back; only the news features are joined.
    """
    return scored(feats, news, breakout_exclude_current).select(*ANALYSIS_COLS)


def daily_stock_analysis_wide(feats: DataFrame, news: DataFrame,
                              breakout_exclude_current: bool = False) -> DataFrame:
    """Same scoring with every intermediate column and the stock key."""
    return scored(feats, news, breakout_exclude_current).select(*WIDE_COLS)
