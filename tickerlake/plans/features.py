"""Per-symbol feature marts: technical, risk, performance and news.

All price statistics are ROWS frames over one stock's series ordered by
``date_key`` and are computed in one pass, so the whole stock series crosses
the network once (one hash exchange on the stock key) however many
indicators there are.  Their cost doesn't grow with the frames' lengths
(``functions.sliding``).

Benchmark statistics (index variance, index 20-day return) are computed on the
benchmark's own series -- one row per trading day -- and joined by date, rather
than with a window over all symbols' rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import safe_div, trailing
from ..functions import sliding
from ..functions.sliding import Frame
from ..functions.windows import ordered
from ..operators import series
from ..operators.dealing import SLOT, dealt
from ..sources.fixtures import BENCHMARK_SYMBOL

# Output columns of the feature tables, in order.
TECHNICAL_COLS = [
    "date_key", "symbol", "open_price", "close_price", "high_price", "low_price", "volume",
    "daily_return", "price_range", "ma_5", "ma_20", "ma_50", "vol_20", "ema_12", "ema_26",
    "macd_line", "prev_close", "gain", "loss", "avg_gain", "avg_loss", "rsi_14",
]
RISK_COLS = TECHNICAL_COLS + ["index_return", "beta_20", "sharpe_20", "drawdown"]
PERFORMANCE_COLS = TECHNICAL_COLS + [
    "resistance_level", "support_level", "breakout_signal", "trend_direction",
    "rolling_return_20", "cumulative_return", "index_rolling_return_20",
]
# Everything the marts read from the price pass (helper columns stay behind).
PRICE_FEATURE_COLS = (
    ["stock_key"] + TECHNICAL_COLS + ["index_return", "beta_20", "sharpe_20", "drawdown"]
    + PERFORMANCE_COLS[len(TECHNICAL_COLS):] + ["breakout_signal_prior", "volume_zscore_20"]
)
# What is stored of them: the others are made of these in the same row (``with_derived``).
DERIVED_COLS = [
    "daily_return", "price_range", "macd_line", "gain", "loss", "rsi_14", "breakout_signal",
    "trend_direction",
]
PRICE_STORED_COLS = [c for c in PRICE_FEATURE_COLS if c not in DERIVED_COLS]
NEWS_FEATURE_COLS = [
    "date_key", "symbol", "news_count", "news_zscore_20", "volume_zscore_20",
    "news_vs_volume_zscore", "vol_news_corr_20",
]
# Volume statistics of the news mart span 21 bars.
VOLUME_FRAME = Frame("moments", ("volume",), 21,
                     {"avg_volume_20": sliding.mean, "std_volume_20": sliding.stddev})


def volume_z() -> Column:
    return safe_div(F.col("volume") - F.col("avg_volume_20"), "std_volume_20")


def daily_return() -> Column:
    return safe_div(F.col("close_price") - F.col("open_price"), "open_price")


def price_range() -> Column:
    return F.col("high_price") - F.col("low_price")


def gain() -> Column:
    close, prev = F.col("close_price"), F.col("prev_close")
    return F.when(close > prev, close - prev).otherwise(F.lit(0.0))


def loss() -> Column:
    close, prev = F.col("close_price"), F.col("prev_close")
    return F.when(close < prev, prev - close).otherwise(F.lit(0.0))


def stock_base(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact rows with their symbol, daily return and range."""
    f = fact.join(dim.select("stock_key", "symbol"), "stock_key")
    return f.select(
        "date_key",
        "stock_key",
        "symbol",
        "open_price",
        "close_price",
        "high_price",
        "low_price",
        "volume",
        daily_return().alias("daily_return"),
        price_range().alias("price_range"),
        *[c for c in ("carried_max", "carried_first", SLOT) if c in fact.columns],
    )


def index_series(base: DataFrame, benchmark: str = BENCHMARK_SYMBOL,
                 chunk_rows: int | None = series.DEFAULT_CHUNK_ROWS,
                 largest: int | None = None) -> DataFrame:
    """The benchmark's own series with its 20-row statistics.

    One row per benchmark trading day, so the window partition is bounded by
    the calendar, not by the number of symbols (and chunked like any other
    series if it is not).
    """
    idx = base.filter(F.col("symbol") == benchmark).select(
        "symbol",
        "date_key",
        F.col("close_price").alias("index_close"),
        F.col("daily_return").alias("index_return"),
    )
    sr = series.prepare(idx, "symbol", back=20, chunk_rows=chunk_rows, largest=largest)
    out = sr.df.select(
        "*",
        F.var_samp("index_return").over(trailing(sr.part, 19, sr.order)).alias("index_var_20"),
        (
            safe_div("index_close", F.lag("index_close", 20).over(ordered(sr.part, sr.order))) - 1
        ).alias("index_rolling_return_20"),
    )
    return sr.own(out).select(
        "date_key", "index_close", "index_return", "index_var_20", "index_rolling_return_20"
    )


def price_features(
    base: DataFrame,
    index: DataFrame,
    part: str = "stock_key",
    chunk_rows: int | None = series.DEFAULT_CHUNK_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Technical, risk and performance columns for every stock row.

    ``breakout_signal`` compares the close with the highest high of a frame
    that includes the current row, as the original model does;
    ``breakout_signal_prior`` compares it with the 20 rows *before* the
    current one.  A key with more than ``chunk_rows`` rows is processed in
    chunks (``operators.series``).  Partitioning by ``stock_key`` (default,
    a long: cheaper to hash and sort) or by ``symbol`` gives the same rows
    (the dimension maps them one to one).

    A series that begins later than the stock's own (an incremental load) brings
    what came before it: ``carried_first`` and ``carried_max`` in ``base`` are the
    first close and the largest close of the stock's earlier rows, null without any.
    """
    joined = base.join(
        index.select("date_key", "index_return", "index_var_20", "index_rolling_return_20"),
        "date_key",
        "left",
    )
    sr = series.prepare(joined, part, "date_key", back=49, chunk_rows=chunk_rows, largest=largest)
    P, O = sr.part, sr.order
    w0 = ordered(P, O)
    close = F.col("close_price")
    s0 = sr.df.select(
        "*",
        F.lag(close, 1).over(w0).alias("prev_close"),
        F.lag(close, 20).over(w0).alias("close_lag_20"),
    )
    s0 = s0.select("*", gain().alias("gain"), loss().alias("loss"))
    means = {"ma_5": 5, "ma_20": 20, "ma_50": 50, "ema_12": 12, "ema_26": 26}
    s1 = sliding.sliding(s0, P, O, [
        *[Frame("sum", ("close_price",), n, {out: sliding.avg}) for out, n in means.items()],
        Frame("sum", ("gain",), 14, {"avg_gain": sliding.avg}),
        Frame("sum", ("loss",), 14, {"avg_loss": sliding.avg}),
        Frame("moments", ("daily_return",), 20,
              {"avg_return_20": sliding.mean, "vol_20": sliding.stddev}),
        Frame("covar", ("daily_return", "index_return"), 20, {"covar_20": sliding.covar}),
        Frame("max", ("high_price",), 20, {"resistance_level": sliding.extreme}),
        Frame("min", ("low_price",), 20, {"support_level": sliding.extreme}),
        Frame("max", ("high_price",), 20, {"prior_high_20": sliding.extreme}, behind=1),
        VOLUME_FRAME,
    ])
    s1 = s1.withColumn("volume_zscore_20", volume_z())
    s1 = sr.with_first(s1, "close_price", "first_close")
    s1 = sr.with_running_max(s1, "close_price", "running_max_close")
    if "carried_max" in base.columns:
        s1 = s1.withColumns({
            "first_close": F.coalesce("carried_first", "first_close"),
            "running_max_close": F.greatest("carried_max", "running_max_close"),
        })
    out = s1.select(
        "*",
        safe_div("covar_20", "index_var_20").alias("beta_20"),
        safe_div("avg_return_20", "vol_20").alias("sharpe_20"),
        (safe_div(close, "running_max_close") - 1).alias("drawdown"),
        F.coalesce(close > F.col("prior_high_20"), F.lit(False)).alias("breakout_signal_prior"),
        (safe_div(close, "close_lag_20") - 1).alias("rolling_return_20"),
        (safe_div(close, "first_close") - 1).alias("cumulative_return"),
    )
    out = sr.own(out)
    return with_derived(out.select(*_slot(out), *PRICE_STORED_COLS))


def _slot(df: DataFrame) -> list[str]:
    return [c for c in (SLOT,) if c in df.columns]


def with_derived(stored: DataFrame) -> DataFrame:
    """All price features from the stored ones."""
    derived = {
        "daily_return": daily_return(),
        "price_range": price_range(),
        "macd_line": F.col("ema_12") - F.col("ema_26"),
        "gain": gain(),
        "loss": loss(),
        "rsi_14": F.when(F.col("avg_loss") == 0, F.lit(100.0))
        .otherwise(100 - 100 / (1 + safe_div("avg_gain", "avg_loss"))),
        "breakout_signal": F.coalesce(
            F.col("close_price") > F.col("resistance_level"), F.lit(False)),
        "trend_direction": F.when(F.col("ma_5") > F.col("ma_20"), "Uptrend")
        .when(F.col("ma_5") < F.col("ma_20"), "Downtrend")
        .otherwise("Sideways"),
    }
    return stored.select(
        *_slot(stored), *[derived[c].alias(c) if c in derived else F.col(c) for c in PRICE_FEATURE_COLS])


def with_breakout(feats: DataFrame, exclude_current: bool = False) -> DataFrame:
    """Pick the breakout definition (see :func:`price_features`)."""
    if exclude_current:
        return feats.withColumn("breakout_signal", F.col("breakout_signal_prior"))
    return feats


def stock_technical(feats: DataFrame) -> DataFrame:
    return feats.select(*TECHNICAL_COLS)


def stock_risk(feats: DataFrame) -> DataFrame:
    return feats.select(*RISK_COLS)


def stock_performance(feats: DataFrame, breakout_exclude_current: bool = False) -> DataFrame:
    return with_breakout(feats, breakout_exclude_current).select(*PERFORMANCE_COLS)


def news_counts(dim_news: DataFrame) -> DataFrame:
    """Articles per (day, related symbol); a partial count before the shuffle."""
    return (
        dim_news.filter(F.col("related").isNotNull())
        .groupBy("date_key", F.col("related").alias("symbol"))
        .agg(F.count(F.lit(1)).alias("news_count"))
    )


def volume_zscores(base: DataFrame, chunk_rows: int | None = series.DEFAULT_CHUNK_ROWS,
                   largest: int | None = None, key: str = "symbol") -> DataFrame:
    sr = series.prepare(base.select("date_key", key, "volume"), key, back=20,
                        chunk_rows=chunk_rows, largest=largest)
    out = sliding.sliding(sr.df, sr.part, sr.order, [VOLUME_FRAME]).withColumn(
        "volume_zscore_20", volume_z())
    return sr.own(out).select("date_key", key, "volume", "volume_zscore_20")


def news_features(dim_news: DataFrame, base: DataFrame,
                  chunk_rows: int | None = series.DEFAULT_CHUNK_ROWS,
                  largest_stock: int | None = None,
                  largest_news: int | None = None,
                  volume_z: DataFrame | None = None,
                  counts: DataFrame | None = None,
                  key: str = "symbol") -> DataFrame:
    """News-count z-score (21 news days), volume z-score (21 bars), their
    difference and their rolling correlation over the news days.

    ``volume_z`` (date_key, symbol, volume, volume_zscore_20) may come from
    the stored price features, which compute it in their own window pass;
    ``counts`` may be the stored :func:`news_counts` (one row per symbol and
    news day), so the article table is aggregated once.  With ``key`` both have the
    stock's key instead of its symbol, and so has the result; where both are dealt to
    slots alike, news days and bars meet without a shuffle.
    """
    if counts is None:
        counts = news_counts(dim_news)
    if chunk_rows is not None and largest_news is None:
        largest_news = series.largest_key(counts, key)
    nz = series.prepare(counts, key, back=20, chunk_rows=chunk_rows, largest=largest_news)
    framed = sliding.sliding(nz.df, nz.part, nz.order, [Frame(
        "moments", ("news_count",), 21,
        {"avg_news_20": sliding.mean, "std_news_20": sliding.stddev})])
    news_z = nz.own(framed.withColumn("news_zscore_20", safe_div(
        F.col("news_count") - F.col("avg_news_20"), "std_news_20"))).drop(
            "avg_news_20", "std_news_20")
    if volume_z is None:
        volume_z = volume_zscores(base, chunk_rows, largest_stock, key)
    on = ["date_key", key, *(_slot(news_z) and _slot(volume_z))]
    volume_z = volume_z.select(*on, "volume", "volume_zscore_20")
    if SLOT not in on:
        # bars are many against news days: dealt by the join's key into tasks of bounded size
        volume_z = dealt(volume_z, *on)
    joined = news_z.join(volume_z, on, "left")
    # one row per news day when the bars keep their grain: size as the news series
    sr = series.prepare(joined, key, back=20, chunk_rows=chunk_rows, largest=largest_news)
    out = sliding.sliding(sr.df, sr.part, sr.order, [Frame(
        "pair", ("news_count", "volume"), 21, {"vol_news_corr_20": sliding.corr})])
    out = sr.own(out)
    return out.select(
        *_slot(out),
        "date_key",
        key,
        "news_count",
        "news_zscore_20",
        "volume_zscore_20",
        (F.col("news_zscore_20") - F.col("volume_zscore_20")).alias("news_vs_volume_zscore"),
        "vol_news_corr_20",
    )
