"""Write every model of a build as a stored table (a full warehouse run).

Layout choices for readers of the stored tables:

* day-grain tables carrying ``date_key`` are partitioned by month
  (``month_key = date_key div 100``), so incremental loads rewrite only the
  months they touch and date filters prune whole folders;
* rows are range-partitioned and sorted by the model's natural order
  (month, then symbol / key, then day) -- the ORDER BY of the original table
  builds, applied where it helps: balanced write tasks, few files per month,
  and files with contiguous key ranges for pruning;
* with ``database`` set, tables are registered in the catalog
  (``saveAsTable``) instead of written to bare paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import with_month
from .build import Build

# model name -> (builder, within-partition sort columns)
MODELS = {
    "dim_stock": (lambda b: b.dim_stock, ["stock_key"]),
    "dim_news": (lambda b: b.dim_news, ["news_key"]),
    "dim_weather": (lambda b: b.dim_weather, ["city", "date_key"]),
    "fact_stock": (lambda b: b.fact_stock, ["stock_key", "date_key"]),
    "bridge_daily_news": (lambda b: b.bridge_daily_news, ["date_key", "news_key"]),
    "bridge_daily_weather": (lambda b: b.bridge_daily_weather, ["date_key", "weather_key"]),
    "mart_stock_technical": (lambda b: b.stock_technical(), ["symbol", "date_key"]),
    "mart_stock_risk": (lambda b: b.stock_risk(), ["symbol", "date_key"]),
    "mart_stock_performance": (lambda b: b.stock_performance(), ["symbol", "date_key"]),
    "mart_news_features": (lambda b: b.news_features(), ["symbol", "date_key"]),
    "daily_stock_analysis": (lambda b: b.daily_stock_analysis(), ["symbol", "date_key"]),
    "daily_stock_analysis_wide": (lambda b: b.daily_stock_analysis_wide(), ["stock_key", "date_key"]),
    "dim_symbols": (lambda b: b.symbol_profile, ["symbol"]),
    "dim_weather_cities": (lambda b: b.city_climate, ["city"]),
    "fct_daily_stocks": (lambda b: b.daily_stocks, ["symbol", "trade_date"]),
    "fct_daily_weather": (lambda b: b.daily_weather, ["city", "date"]),
    "stock_news_daily": (lambda b: b.stock_news_daily, ["symbol", "trade_date"]),
    "weather_market_conditions": (lambda b: b.weather_market_conditions, ["city", "trade_date"]),
    "market_volatility_metrics": (lambda b: b.volatility_metrics, ["symbol"]),
    "daily_stock_scientist": (lambda b: b.ml_features(), ["stock_key", "date_key", "city"]),
}


def write_model(df: DataFrame, sort_cols: list[str], path: str | None = None,
                table: str | None = None) -> None:
    partition = []
    days = [c for c in ("date_key", "trade_date", "date") if c in df.columns]
    if days:
        df = with_month(df, days[0])
        partition = ["month_key"]
    order = [F.col(c).asc_nulls_last() for c in [*partition, *sort_cols]]
    # range partitioning on (month, sort key): balanced tasks, few files per
    # month, and files holding contiguous key ranges
    writer = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")  # a full rebuild replaces every month
        .partitionBy(*partition)
        .format("parquet")
    )
    if table:
        writer.saveAsTable(table)
    else:
        writer.save(path)


def write_models(build: Build, out_dir: str | None = None, database: str | None = None,
                 names: list[str] | None = None) -> dict[str, str]:
    """Write the selected models (all by default); returns name -> location."""
    written = {}
    for name in names or list(MODELS):
        make, sort_cols = MODELS[name]
        if database:
            loc = f"{database}.{name}"
            write_model(make(build), sort_cols, table=loc)
        else:
            loc = f"{out_dir.rstrip('/')}/{name}"
            write_model(make(build), sort_cols, path=loc)
        written[name] = loc
    return written
