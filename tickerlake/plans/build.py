"""One build of the whole model graph over a set of input tables.

Each layer is built once and shared by the layers above it.  Like the
warehouse it replaces, the RAW feeds and the warehouse tables (dimensions,
fact, bridges) are materialised as parquet in the shared checkpoint folder
when first requested: later stages read files with known sizes (so the
planner broadcasts a dimension only when its files are small and keeps a
shuffle join otherwise), lineage is cut at each layer, and a lost executor
recomputes from the last written table.  Marts stay lazy DataFrames.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..functions import with_month
from ..operators import series
from ..operators.dealing import dealt, dealt_to, sent_if_small, slots
from ..session import shared_path
from ..sources import fixtures, raw
from . import features, incremental, kept_reports, marts, ml, templates, warehouse


class Build:
    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        sources: dict[str, DataFrame] | None = None,
        materialize: bool = True,
        warehouse_dir: str | None = None,
        chunk_rows: int | None = series.DEFAULT_CHUNK_ROWS,
    ):
        """``warehouse_dir``: stable folder for the stored tables (one folder
        per model, overwritten by each build); by default each build writes
        fresh folders under the shared checkpoint folder.  ``chunk_rows``:
        rows of one key a window task takes before its series is chunked."""
        self.spark = spark
        self.sf_dir = sf_dir
        self._sources = sources
        self.materialize = materialize
        self.warehouse_dir = warehouse_dir
        self.chunk_rows = chunk_rows

    def table(self, df: DataFrame, name: str, day: str | None = None) -> DataFrame:
        """Write ``df`` as a parquet table and read it back; with ``day`` in
        folders by that date column's month (``month_key``), which a filter on
        the month skips."""
        if not self.materialize:
            return df
        if day:
            df = with_month(df, day).repartitionByRange("month_key", day)
        if self.warehouse_dir:
            path = f"{self.warehouse_dir.rstrip('/')}/{name}"
        else:
            path = shared_path(self.spark, name)
        writer = df.write.mode("overwrite")
        (writer.partitionBy("month_key") if day else writer).parquet(path)
        return self.spark.read.parquet(path)

    # -- staging ---------------------------------------------------------
    def _feed(self, name: str) -> DataFrame:
        if self._sources is not None:
            return self.table(self._sources[name], f"feed_{name}")
        make = {
            "news": fixtures.news_api,
            "stocks": fixtures.stock_api,
            "weather": fixtures.weather_api,
        }[name]
        feed = make(self.spark, self.sf_dir)
        if name == "stocks" and not self.warehouse_dir:
            return feed  # a view of tables that are staged already
        return self.table(feed, f"feed_{name}")

    @cached_property
    def raw_news(self) -> DataFrame:
        return raw.raw_news(self._feed("news"))

    @cached_property
    def raw_stocks(self) -> DataFrame:
        return raw.raw_stocks(self._feed("stocks"))

    @cached_property
    def raw_weather(self) -> DataFrame:
        return raw.raw_weather(self._feed("weather"))

    # -- warehouse -------------------------------------------------------
    @cached_property
    def dim_stock(self) -> DataFrame:
        return self.table(warehouse.dim_stock(self.raw_stocks), "dim_stock")

    @cached_property
    def symbols(self) -> DataFrame:
        """The stock dimension as the bars' joins read it: bars aren't shuffled for a small one."""
        return sent_if_small(self.dim_stock)

    @cached_property
    def dim_news(self) -> DataFrame:
        # the numbered articles are staged already: written again only to a folder of its own
        numbered = warehouse.dim_news(self.raw_news)
        return self.table(numbered, "dim_news") if self.warehouse_dir else numbered

    @cached_property
    def dim_weather(self) -> DataFrame:
        return self.table(warehouse.dim_weather(self.raw_weather), "dim_weather")

    @cached_property
    def fact_stock(self) -> DataFrame:
        return self.table(warehouse.fact_stock(self.raw_stocks, self.symbols), "fact_stock")

    @cached_property
    def bridge_daily_news(self) -> DataFrame:
        return self.table(
            warehouse.bridge_daily_news(self.raw_news, self.dim_news), "bridge_daily_news"
        )

    @cached_property
    def bridge_daily_weather(self) -> DataFrame:
        return self.table(
            warehouse.bridge_daily_weather(self.raw_weather, self.dim_weather),
            "bridge_daily_weather",
        )

    # -- feature marts ---------------------------------------------------
    @cached_property
    def stock_base(self) -> DataFrame:
        return features.stock_base(self.fact_stock, self.symbols)

    @cached_property
    def largest_stock_series(self) -> int:
        """Rows of the longest stock series (one aggregate row); sizes the
        window tasks of every per-symbol feature."""
        return series.largest_key(self.fact_stock, "stock_key")

    @cached_property
    def news_count_table(self) -> DataFrame:
        """Articles per (day, symbol): one aggregation of the article table,
        stored; sizes the news series and feeds the news features."""
        return self.table(features.news_counts(self.dim_news), "news_counts")

    @cached_property
    def largest_news_series(self) -> int:
        return series.largest_key(self.news_count_table, "symbol")

    @cached_property
    def index_series(self) -> DataFrame:
        # One row per benchmark day; stored so its file size decides whether
        # the per-day join is a broadcast.
        return self.table(
            features.index_series(
                self.stock_base, chunk_rows=self.chunk_rows, largest=self.largest_stock_series
            ),
            "index_series",
        )

    @cached_property
    def news_feature_table(self) -> DataFrame:
        return self.table(
            features.news_features(
                self.dim_news, self.stock_base,
                chunk_rows=self.chunk_rows,
                largest_stock=self.largest_stock_series, largest_news=self.largest_news_series,
                volume_z=self.price_features, counts=self.news_count_table,
            ),
            "news_features",
        )

    @cached_property
    def price_pass(self) -> DataFrame:
        """All per-symbol price columns in one window pass, made where they are read: a
        reader of some columns has only the windows of those."""
        # dealt before its joins add columns; the windows need no other shuffle
        return self._prices(dealt(self.fact_stock, "stock_key"))

    def _prices(self, fact: DataFrame) -> DataFrame:
        return features.price_features(
            features.stock_base(fact, self.symbols), self.index_series,
            chunk_rows=self.chunk_rows, largest=self.largest_stock_series,
        )

    @cached_property
    def price_feature_table(self) -> DataFrame:
        """The price columns stored, for marts that join or read them more than once.
        What a row's other columns tell is not stored but made when it is read."""
        return features.with_derived(
            self.table(self.price_pass.select(*features.PRICE_STORED_COLS), "price_features"))

    @property
    def price_features(self) -> DataFrame:
        """The stored price columns where a mart has had them stored, else the pass itself:
        a mart that reads them once writes no table of all of them before."""
        stored = "price_feature_table" in self.__dict__  # cached
        return self.price_feature_table if stored else self.price_pass

    @cached_property
    def market_store(self) -> incremental.MarketStore:
        """A store brought to the same bars by three loads, one with corrections."""
        return incremental.three_loads(self)

    @cached_property
    def top_news(self) -> kept_reports.TopNews:
        """Each day's bars with most articles, kept over two loads that overlap."""
        return kept_reports.two_loads(self)

    def stock_technical(self) -> DataFrame:
        return features.stock_technical(self.price_features)

    def stock_risk(self) -> DataFrame:
        return features.stock_risk(self.price_features)

    def stock_performance(self, breakout_exclude_current: bool = False) -> DataFrame:
        return features.stock_performance(self.price_features, breakout_exclude_current)

    def news_features(self) -> DataFrame:
        return self.news_feature_table

    @cached_property
    def scored_sides(self) -> tuple[DataFrame, DataFrame]:
        """Price and news features for the scored marts, none stored: bars and news days
        are dealt by stock while they are narrow, once, and stay there.  The rows with all
        features are never shuffled; the bars' shuffle is read twice, for news too."""
        n = slots(self.fact_stock)
        prices = self._prices(dealt_to(self.fact_stock, "stock_key", n))
        # symbols without a bar have no row to be scored
        counts = self.news_count_table.join(self.symbols, "symbol").select(
            "date_key", "stock_key", "news_count")
        news = features.news_features(
            self.dim_news, self.stock_base, chunk_rows=self.chunk_rows,
            largest_stock=self.largest_stock_series, largest_news=self.largest_news_series,
            volume_z=prices, counts=dealt_to(counts, "stock_key", n), key="stock_key",
        )
        return prices, news

    @cached_property
    def scored_table(self) -> DataFrame:
        """The scored join of price and news features, stored for who reads it more than once."""
        return self.table(marts.scored(*self.scored_sides), "scored")

    def daily_stock_analysis(self, breakout_exclude_current: bool = False) -> DataFrame:
        if "scored_table" in self.__dict__ and not breakout_exclude_current:  # cached
            return self.scored_table.select(*marts.ANALYSIS_COLS)
        return marts.daily_stock_analysis(*self.scored_sides, breakout_exclude_current)

    def daily_stock_analysis_wide(self, breakout_exclude_current: bool = False) -> DataFrame:
        if "scored_table" in self.__dict__ and not breakout_exclude_current:
            return self.scored_table.select(*marts.WIDE_COLS)
        return marts.daily_stock_analysis_wide(*self.scored_sides, breakout_exclude_current)

    def ml_features(self) -> DataFrame:
        return ml.ml_features(
            self.fact_stock, self.dim_stock, self.bridge_daily_weather, self.dim_weather,
            self.bridge_daily_news, chunk_rows=self.chunk_rows, largest=self.largest_stock_series,
        )

    # -- template marts --------------------------------------------------
    @cached_property
    def symbol_profile(self) -> DataFrame:
        return templates.symbol_profile(self.raw_stocks)

    @cached_property
    def city_climate(self) -> DataFrame:
        return templates.city_climate(self.raw_weather)

    @cached_property
    def daily_bars(self) -> DataFrame:
        # read by the weather-market mart and a report, which need no lists
        return self.table(templates.daily_bars(self.raw_stocks, self.raw_news), "daily_bars")

    @cached_property
    def daily_stocks(self) -> DataFrame:
        # warehouse fact read by the stock-news mart
        return self.table(templates.daily_stocks(self.raw_stocks, self.raw_news), "daily_stocks")

    @cached_property
    def daily_weather(self) -> DataFrame:
        return templates.daily_weather(self.raw_weather)

    @cached_property
    def stock_news_daily(self) -> DataFrame:
        # mart read by two reports
        return self.table(
            templates.stock_news_daily(
                self.daily_stocks,
                sent_if_small(self.table(self.symbol_profile, "symbol_profile"))),
            "stock_news_daily", day="trade_date",
        )

    @cached_property
    def weather_market_conditions(self) -> DataFrame:
        return self.table(
            templates.weather_market_conditions(
                self.daily_weather, self.city_climate, self.daily_bars
            ),
            "weather_market_conditions",
        )

    @cached_property
    def volatility_metrics(self) -> DataFrame:
        return templates.volatility_metrics(self.raw_stocks)
