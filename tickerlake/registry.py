"""Registered queries: Spark builder, output contract and SQL oracle per name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from . import contract, oracle
from .operators import quality
from .plans import checks, intake, reports
from .plans.build import Build
from .plans.incremental import incremental_dim_weather, incremental_fact

TECH = (
    "date_key:i symbol:s open_price:d close_price:d high_price:d low_price:d volume:l "
    "daily_return:d price_range:d ma_5:d ma_20:d ma_50:d vol_20:d ema_12:d ema_26:d "
    "macd_line:d prev_close:d gain:d loss:d avg_gain:d avg_loss:d rsi_14:d"
)
RISK = TECH + " index_return:d beta_20:d sharpe_20:d drawdown:d"
PERF = TECH + (
    " resistance_level:d support_level:d breakout_signal:b trend_direction:s "
    "rolling_return_20:d cumulative_return:d index_rolling_return_20:d"
)
NEWS = (
    "date_key:i symbol:s news_count:l news_zscore_20:d volume_zscore_20:d "
    "news_vs_volume_zscore:d vol_news_corr_20:d"
)
ANALYSIS = (
    "date_key:i symbol:s open_price:d close_price:d high_price:d low_price:d volume:l "
    "daily_return:d price_range:d ma_5:d ma_20:d ma_50:d macd_line:d rsi_14:d vol_20:d "
    "beta_20:d sharpe_20:d drawdown:d resistance_level:d support_level:d breakout_signal:b "
    "trend_direction:s rolling_return_20:d cumulative_return:d index_rolling_return_20:d "
    "news_count:l news_zscore_20:d volume_zscore_20:d news_vs_volume_zscore:d "
    "vol_news_corr_20:d score:i recommendation:s"
)
WIDE = (
    "date_key:i stock_key:l symbol:s open_price:d close_price:d high_price:d low_price:d "
    "volume:l daily_return:d price_range:d ma_5:d ma_20:d ma_50:d vol_20:d ema_12:d ema_26:d "
    "macd_line:d prev_close:d gain:d loss:d avg_gain:d avg_loss:d rsi_14:d index_return:d "
    "beta_20:d sharpe_20:d drawdown:d resistance_level:d support_level:d breakout_signal:b "
    "trend_direction:s rolling_return_20:d cumulative_return:d index_rolling_return_20:d "
    "news_count:l news_zscore_20:d volume_zscore_20:d news_vs_volume_zscore:d "
    "vol_news_corr_20:d score:i recommendation:s"
)
DAILY_STOCKS = (
    "symbol:s trade_date:t open:d high:d low:d close:d volume:l daily_range:d daily_change:d "
    "pct_change:d direction:s news_article_count:l news_categories:a headlines:a"
)
WEATHER_DIM = (
    "weather_key:s date_key:i city:s appt_max:d appt_min:d appt_temp_range:d max_temp:d "
    "min_temp:d precip:d max_wind:d sunrise:l sunset:l daylight_duration:d temp_range_c:d"
)
FACT = "date_key:i stock_key:l open_price:d high_price:d low_price:d close_price:d volume:l"
ML = (
    "date_key:i stock_key:l symbol:s city:s next_day_return:d daily_return:d return_lag_1:d "
    "return_lag_3:d return_lag_5:d ma_5:d ma_20:d vol_20:d avg_temp:d temp_change:d "
    "humidity:d humidity_change:d wind_speed:d precipitation:d cloud_cover:d "
    "weather_condition:s news_count:l news_count_lag_1:l news_count_lag_3:l "
    "news_count_roll_5:d return_x_temp:d return_x_news:d vol_x_news:d"
)

FEATURES = RISK + PERF.removeprefix(TECH)
PROFILE = (
    "symbol:s first_seen_date:t last_seen_date:t total_trading_days:l all_time_high:d "
    "all_time_low:d avg_close_price:d avg_daily_volume:d"
)
VOLATILITY = (
    "symbol:s trading_days:l first_trade_date:t last_trade_date:t period_high:d period_low:d "
    "avg_close:d avg_daily_volume:d total_volume:l avg_daily_range:d return_volatility:d "
    "avg_daily_return_pct:d up_days:l down_days:l"
)

TECH_COLS = ", ".join(n for n, _ in contract.parse_spec(TECH))


_BUILDS: dict[tuple[str, str], Build] = {}


def shared_build(spark: SparkSession, sf_dir: str) -> Build:
    """One build per application and input, so its queries share feeds and tables."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _BUILDS:
        _BUILDS[key] = Build(spark, sf_dir)
    return _BUILDS[key]


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Build], DataFrame]
    spec: str
    sql: str | None  # final SELECT over oracle.MODELS; None = no SQL oracle

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return contract.apply_spark(self.build(shared_build(spark, sf_dir)), self.spec)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        return contract.apply_sql(oracle.with_models(self.sql), self.spec)


def _cols(spec: str, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{n}" for n, _ in contract.parse_spec(spec))


# Fixed value: days before the stored maximum that an overlapping load reads again.
LOOKBACK_DAYS = 45
D = reports.REPORT_DAY
C = reports.REPORT_CITY
K = reports.TOP_K
ARTICLES = (
    "symbol:s trade_date:t open:d high:d low:d close:d volume:l daily_range:d pct_change:d "
    "news_article_count:l"
)
ARTICLE_COUNT_SQL = f"""SELECT s.symbol, s.trade_date, s.open, s.high, s.low, s.close, s.volume,
       s.high - s.low AS daily_range,
       {oracle.rhu(oracle.sdiv('s.close - s.open', 's.open') + ' * 100', 4)} AS pct_change,
       count(n.id) AS news_article_count
FROM (SELECT *, CAST(datetime AS DATE) AS trade_date FROM raw_stocks) s
LEFT JOIN raw_news n ON s.symbol = n.related AND s.trade_date = CAST(n.datetime AS DATE)
GROUP BY s.symbol, s.trade_date, s.open, s.high, s.low, s.close, s.volume
ORDER BY news_article_count DESC, s.symbol NULLS LAST, s.trade_date NULLS LAST,
         s.open NULLS LAST, s.high NULLS LAST, s.low NULLS LAST, s.close NULLS LAST,
         s.volume NULLS LAST
LIMIT {K}"""

QUERIES: list[Query] = [
    # warehouse
    Query("dim_stock", lambda b: b.dim_stock, "stock_key:l symbol:s", "SELECT * FROM dim_stock"),
    Query(
        "dim_news",
        lambda b: b.dim_news,
        "news_key:l news_id:l category:s headline:s summary:s url:s image:s source:s related:s "
        "date_key:i",
        "SELECT * FROM dim_news",
    ),
    Query("dim_weather", lambda b: b.dim_weather, WEATHER_DIM, "SELECT * FROM dim_weather"),
    Query("fact_stock", lambda b: b.fact_stock, FACT, "SELECT * FROM fact_stock"),
    Query(
        "bridge_daily_news",
        lambda b: b.bridge_daily_news,
        "date_key:i news_key:l",
        "SELECT * FROM bridge_daily_news",
    ),
    Query(
        "bridge_daily_weather",
        lambda b: b.bridge_daily_weather,
        "date_key:i weather_key:s",
        "SELECT * FROM bridge_daily_weather",
    ),
    # feature marts
    Query("stock_technical", lambda b: b.stock_technical(), TECH, f"SELECT {TECH_COLS} FROM px"),
    Query("stock_risk", lambda b: b.stock_risk(), RISK, f"SELECT {_cols(RISK)} FROM px"),
    Query("stock_performance", lambda b: b.stock_performance(), PERF, f"SELECT {_cols(PERF)} FROM px"),
    Query("news_features", lambda b: b.news_features(), NEWS, "SELECT * FROM news_features"),
    Query(
        "daily_stock_analysis",
        lambda b: b.daily_stock_analysis(),
        ANALYSIS,
        f"SELECT {_cols(ANALYSIS)} FROM analysis",
    ),
    Query(
        "daily_stock_analysis_wide",
        lambda b: b.daily_stock_analysis_wide(),
        WIDE,
        f"SELECT {_cols(WIDE)} FROM analysis",
    ),
    # template marts
    Query(
        "symbol_profile",
        lambda b: b.symbol_profile,
        PROFILE,
        "SELECT * FROM symbol_profile",
    ),
    Query(
        "city_climate",
        lambda b: b.city_climate,
        "city:s first_observation_date:t last_observation_date:t total_observation_days:l "
        "avg_max_temp:d avg_min_temp:d avg_daily_precip:d avg_max_wind:d hottest_day_temp:d "
        "coldest_day_temp:d wettest_day_precip:d",
        "SELECT * FROM city_climate",
    ),
    Query("daily_stocks", lambda b: b.daily_stocks, DAILY_STOCKS, "SELECT * FROM daily_stocks"),
    Query(
        "daily_weather",
        lambda b: b.daily_weather,
        "date:t city:s max_temp:d min_temp:d precip:d max_wind:d",
        "SELECT * FROM daily_weather",
    ),
    Query(
        "stock_news_daily",
        lambda b: b.stock_news_daily,
        DAILY_STOCKS + " all_time_high:d all_time_low:d avg_close_price:d pct_from_ath:d",
        "SELECT * FROM stock_news_daily",
    ),
    Query(
        "weather_market_conditions",
        lambda b: b.weather_market_conditions,
        "trade_date:t city:s max_temp:d min_temp:d precip:d max_wind:d city_normal_max_temp:d "
        "temp_deviation_from_normal:d stocks_tracked:l avg_pct_change:d avg_daily_range:d "
        "total_market_volume:l stocks_up:l stocks_down:l stocks_flat:l",
        "SELECT * FROM weather_market_conditions",
    ),
    Query(
        "volatility_metrics",
        lambda b: b.volatility_metrics,
        VOLATILITY,
        "SELECT * FROM volatility_metrics",
    ),
    Query("ml_features", lambda b: b.ml_features(), ML, f"SELECT {_cols(ML)} FROM ml_features"),
    # reports (example queries)
    Query(
        "report_top_news",
        lambda b: reports.top_news_on_day(b.stock_news_daily),
        "symbol:s trade_date:t close:d pct_change:d news_article_count:l headlines:a",
        f"""SELECT symbol, trade_date, close, {oracle.rhu('pct_change', 2)} AS pct_change,
                   news_article_count, headlines
            FROM stock_news_daily WHERE trade_date = DATE '{D}'
            ORDER BY news_article_count DESC NULLS LAST, symbol NULLS LAST LIMIT {K}""",
    ),
    Query(
        "report_news_vs_move",
        lambda b: reports.news_vs_move(b.stock_news_daily),
        "symbol:s avg_news_count:d avg_abs_pct_change:d",
        f"""SELECT symbol, avg(news_article_count) AS avg_news_count,
                   avg(abs(pct_change)) AS avg_abs_pct_change
            FROM stock_news_daily GROUP BY symbol
            ORDER BY avg_abs_pct_change DESC NULLS LAST, symbol NULLS LAST LIMIT {K}""",
    ),
    Query(
        "report_weather_type",
        lambda b: reports.weather_type_summary(b.weather_market_conditions),
        "city:s weather_type:s trading_days:l avg_market_return_pct:d avg_stocks_up:d "
        "avg_stocks_down:d",
        f"""SELECT city,
                   CASE WHEN precip > 5 THEN 'Rainy (>5mm)' WHEN precip > 0 THEN 'Light Rain (0-5mm)'
                        ELSE 'Dry' END AS weather_type,
                   count(*) AS trading_days,
                   {oracle.rhu(oracle.eavg('avg_pct_change'), 4)} AS avg_market_return_pct,
                   {oracle.rhu(oracle.eavg('stocks_up'), 0)} AS avg_stocks_up,
                   {oracle.rhu(oracle.eavg('stocks_down'), 0)} AS avg_stocks_down
            FROM weather_market_conditions WHERE city = '{C}'
            GROUP BY 1, 2 ORDER BY weather_type""",
    ),
    Query(
        "report_volatile",
        lambda b: reports.most_volatile(b.volatility_metrics),
        "symbol:s trading_days:l period_high:d period_low:d avg_close:d return_volatility:d "
        "avg_daily_return_pct:d up_days:l down_days:l",
        f"""SELECT symbol, trading_days, period_high, period_low,
                   {oracle.rhu('avg_close', 2)} AS avg_close,
                   {oracle.rhu('return_volatility', 4)} AS return_volatility,
                   {oracle.rhu('avg_daily_return_pct', 4)} AS avg_daily_return_pct,
                   up_days, down_days
            FROM volatility_metrics
            ORDER BY 6 DESC NULLS LAST, symbol NULLS LAST LIMIT {K}""",
    ),
    Query(
        "report_article_count",
        lambda b: reports.top_article_counts(b.daily_bars),
        ARTICLES,
        ARTICLE_COUNT_SQL,
    ),
    Query(
        "report_preview",
        lambda b: reports.preview(b.raw_stocks, ["symbol", "datetime"]),
        "symbol:s datetime:t open:d high:d low:d close:d volume:l",
        """SELECT * FROM raw_stocks ORDER BY symbol NULLS LAST, datetime NULLS LAST LIMIT 10""",
    ),
    Query(
        "report_preview_weather",
        lambda b: reports.preview(b.raw_weather, ["city", "raw_date"]),
        "raw_date:t city:s max_temp:d min_temp:d precip:d max_wind:d appt_max:d appt_min:d "
        "appt_temp_range:d temp_range_c:d daylight_duration:d sunrise:l sunset:l",
        """SELECT * FROM raw_weather ORDER BY city NULLS LAST, raw_date NULLS LAST LIMIT 10""",
    ),
    Query(
        "report_preview_news",
        lambda b: reports.preview(b.raw_news, ["id", "datetime"]),
        "id:l headline:s datetime:s category:s source:s related:s summary:s url:s image:s",
        """SELECT * FROM raw_news ORDER BY id NULLS LAST, datetime NULLS LAST LIMIT 10""",
    ),
    Query(
        "intake_stocks",
        intake.intake_stocks,
        "symbol:s datetime:t open:d high:d low:d close:d volume:l currency:s reasons:a",
        """SELECT CASE WHEN messy NOT IN (2, 4) THEN symbol END AS symbol,
                  CASE WHEN messy NOT IN (0, 4) THEN CAST(datetime AS DATE) END AS datetime,
                  CASE WHEN messy <> 4 THEN open END AS open,
                  CASE WHEN messy <> 4 THEN high END AS high,
                  CASE WHEN messy <> 4 THEN low END AS low,
                  CASE WHEN messy NOT IN (1, 4) THEN close END AS close,
                  CASE WHEN messy = 3 THEN -volume - 1 WHEN messy <> 4 THEN volume END AS volume,
                  CASE WHEN messy <> 4 AND year(datetime) % 3 = 2 THEN 'USD' END AS currency,
                  CASE messy WHEN 0 THEN ['bad datetime'] WHEN 1 THEN ['bad close']
                             WHEN 2 THEN ['missing symbol'] WHEN 3 THEN ['rule volume']
                             WHEN 4 THEN ['unreadable'] ELSE CAST([] AS VARCHAR[]) END AS reasons
           FROM (SELECT *, volume % 50 AS messy FROM raw_stocks) AS s""",
    ),
    Query(
        "load_counts",
        lambda b: reports.load_counts(
            {"raw_news": b.raw_news, "raw_stocks": b.raw_stocks, "raw_weather": b.raw_weather}
        ),
        "table_name:s row_count:l",
        """SELECT 'raw_news' AS table_name, count(*) AS row_count FROM raw_news
           UNION ALL SELECT 'raw_stocks', count(*) FROM raw_stocks
           UNION ALL SELECT 'raw_weather', count(*) FROM raw_weather""",
    ),
    Query(
        "quality_report",
        lambda b: quality.quality_report(
            {"raw_news": b.raw_news, "raw_stocks": b.raw_stocks, "raw_weather": b.raw_weather}
        ),
        "table_name:s column_name:s check_name:s failures:l",
        oracle.quality_sql(quality.SOURCE_CHECKS),
    ),
    Query(
        "quality_relationships",
        lambda b: quality.relationship_report([
            ("raw_stocks", b.raw_stocks, "symbol", b.dim_stock, "symbol"),
            ("raw_news", b.raw_news, "related", b.dim_stock, "symbol"),
            ("fact_stock", b.fact_stock, "stock_key", b.dim_stock, "stock_key"),
            ("bridge_daily_news", b.bridge_daily_news, "news_key", b.dim_news, "news_key"),
            ("bridge_daily_weather", b.bridge_daily_weather, "weather_key", b.dim_weather,
             "weather_key"),
        ]),
        "table_name:s column_name:s check_name:s failures:l",
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS table_name, '{k}' AS column_name, 'relationships' AS check_name, "
            f"CAST(count(*) AS BIGINT) AS failures FROM {c} x WHERE x.{k} IS NOT NULL AND NOT "
            f"EXISTS (SELECT 1 FROM {p} y WHERE y.{q} = x.{k})"
            for c, k, p, q in [("raw_stocks", "symbol", "dim_stock", "symbol"),
                               ("raw_news", "related", "dim_stock", "symbol"),
                               ("fact_stock", "stock_key", "dim_stock", "stock_key"),
                               ("bridge_daily_news", "news_key", "dim_news", "news_key"),
                               ("bridge_daily_weather", "weather_key", "dim_weather", "weather_key")]
        ),
    ),
    Query(
        "quality_grain",
        lambda b: quality.grain_report([
            ("raw_stocks", b.raw_stocks, ["symbol", "datetime"]),
            ("raw_weather", b.raw_weather, ["city", "raw_date"]),
            ("fact_stock", b.fact_stock, ["stock_key", "date_key"]),
            ("dim_weather", b.dim_weather, ["city", "date_key"]),
        ]),
        "table_name:s column_name:s check_name:s failures:l",
        "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, '{cols}' AS column_name, "
            f"'unique_combination' AS check_name, CAST(count(*) AS BIGINT) AS failures "
            f"FROM (SELECT {cols} FROM {t} GROUP BY {cols} HAVING count(*) > 1) AS d"
            for t, cols in [("raw_stocks", "symbol,datetime"), ("raw_weather", "city,raw_date"),
                            ("fact_stock", "stock_key,date_key"), ("dim_weather", "city,date_key")]
        ),
    ),
    # incremental loads: two loads (to the cut-off day, then all) == full build
    Query("incremental_fact", lambda b: incremental_fact(b), FACT, "SELECT * FROM fact_stock"),
    Query(
        "incremental_weather",
        lambda b: incremental_dim_weather(b),
        WEATHER_DIM,
        "SELECT * FROM dim_weather",
    ),
    # the same with a second load that overlaps stored days and replaces their rows
    Query(
        "incremental_fact_overlap",
        lambda b: incremental_fact(b, lookback_days=LOOKBACK_DAYS),
        FACT,
        "SELECT * FROM fact_stock",
    ),
    Query(
        "incremental_weather_overlap",
        lambda b: incremental_dim_weather(b, lookback_days=LOOKBACK_DAYS),
        WEATHER_DIM,
        "SELECT * FROM dim_weather",
    ),
    # three loads, the last with corrections of the first: what follows the fact is
    # brought up to date from what changed, and equals the full build
    Query(
        "incremental_fact_corrected", lambda b: b.market_store.fact_stock(), FACT,
        "SELECT * FROM fact_stock",
    ),
    Query(
        "incremental_features", lambda b: b.market_store.price_features(), FEATURES,
        f"SELECT {_cols(FEATURES)} FROM px",
    ),
    Query(
        "incremental_profile", lambda b: b.market_store.symbol_profile(), PROFILE,
        "SELECT * FROM symbol_profile",
    ),
    Query(
        "incremental_volatility", lambda b: b.market_store.volatility_metrics(), VOLATILITY,
        "SELECT * FROM volatility_metrics",
    ),
    Query(
        "incremental_stocks_tracked", lambda b: b.market_store.stocks_tracked(),
        "span:s start_key:i stocks_tracked:l",
        """SELECT 'day' AS span, date_key AS start_key, count(DISTINCT stock_key) AS stocks_tracked
           FROM fact_stock GROUP BY date_key
           UNION ALL SELECT 'month', date_key // 100 * 100 + 1, count(DISTINCT stock_key)
           FROM fact_stock GROUP BY date_key // 100
           UNION ALL SELECT 'year', date_key // 10000 * 10000 + 101, count(DISTINCT stock_key)
           FROM fact_stock GROUP BY date_key // 10000""",
    ),
    # lists kept over two loads that overlap: equal to those of the whole table
    Query(
        "incremental_top_news", lambda b: b.top_news.by_day(),
        "trade_date:t symbol:s close:d pct_change:d news_article_count:l",
        f"""SELECT trade_date, symbol, close, pct_change, news_article_count FROM daily_stocks
            QUALIFY row_number() OVER (PARTITION BY trade_date ORDER BY
                news_article_count DESC NULLS LAST, symbol NULLS LAST) <= {K}""",
    ),
    Query(
        "incremental_article_count", lambda b: b.top_news.over_all(), ARTICLES, ARTICLE_COUNT_SQL,
    ),
    # checks after three loads, one of them sent twice: equal to those of the whole feeds
    Query(
        "incremental_quality", checks.incremental_quality,
        "table_name:s column_name:s check_name:s failures:l",
        "\nUNION ALL\n".join(
            [oracle.quality_sql(quality.SOURCE_CHECKS)]
            + [f"SELECT '{t}' AS table_name, '{','.join(cols)}' AS column_name, "
               f"'unique_combination' AS check_name, CAST(count(*) AS BIGINT) AS failures FROM "
               f"(SELECT 1 FROM {t} GROUP BY {', '.join(cols)} HAVING count(*) > 1) AS d"
               for t, cols in checks.GRAINS]
            + [f"SELECT '{c}' AS table_name, '{k}' AS column_name, 'relationships' AS check_name, "
               f"CAST(count(*) AS BIGINT) AS failures FROM {c} x WHERE x.{k} IS NOT NULL AND NOT "
               f"EXISTS (SELECT 1 FROM {p} y WHERE y.{q} = x.{k})"
               for c, k, p, q in checks.LINKS]
        ),
    ),
]

BY_NAME = {q.name: q for q in QUERIES}
