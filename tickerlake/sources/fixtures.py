"""Source tables in the three feed shapes, derived from the driver's tables.

The original pipeline receives stock bars, news articles and city weather
from upstream loaders.  Here the same shapes are derived with Spark from the
TPC-H style tables:

* stock bars: one bar per (supplier, ship day) over line items, plus a
  benchmark symbol over all lines; suppliers grow with the input, and so do
  the number of series and of bars;
* news: one article per order, related to the supplier of its first line, so
  a bar's articles stay few at every size;
* weather: one observation per (region, order day); its rows are bounded by
  the calendar, its work grows with the orders.

Bars and first lines are aggregates of about one line each, so lines are dealt
raw, without a partial aggregate that would sort them all before the shuffle for
nothing.  Benchmark and weather have partial aggregates: a hot group (say, the
benchmark, which covers every line) never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dealing import dealt
from ..session import shared_path

# Fixed value: symbol of the market benchmark series.
BENCHMARK_SYMBOL = "SPY"

# Fixed values (feed definitions in FIXTURES.md): article text prefixes, every
# tenth order without a headline, weather scalings (price / 10000 as
# temperature, 2.5 mm per finished order, 10 km/h per order), 12 h daylight,
# sunrise 06:00 and sunset 18:00 UTC.
HEADLINE_PREFIX, SUMMARY_PREFIX, URL_PREFIX = "Order ", "Summary ", "https://example.org/"
NO_HEADLINE_EVERY = 10
TEMP_DIVISOR, PRECIP_PER_FINISHED, WIND_PER_ORDER = 10000, 2.5, 10.0
DAYLIGHT_SECONDS, SUNRISE_SECONDS, SUNSET_SECONDS = 43200.0, 21600, 64800

# Fixed value: a supplier's symbol is this letter and its key.
SYMBOL_PREFIX = "S"

# Ordering of line items inside a bar (first line = open,
# last line = close) and inside an order (first line = related supplier).
BAR_LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
ORDER_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _supplier_bars(lines: DataFrame) -> DataFrame:
    """One row per supplier and day: its number of lines, the first and last of them by
    ``BAR_LINE_ORDER``, highest and lowest price, quantity.  The supplier is one within
    a bar, so the lines' order needs it not.  A bar of one line (most are) has no
    last line and no prices of its own: they are the first line's."""
    order = F.struct(*[F.col(c) for c in BAR_LINE_ORDER if c != "l_suppkey"])
    several = F.col("lines") > 1
    bars = dealt(lines, "l_suppkey", "datetime").groupBy("l_suppkey", "datetime").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min(order).alias("first_line"),
        F.max(order).alias("last_line"),
        F.max("l_extendedprice").alias("high"),
        F.min("l_extendedprice").alias("low"),
        F.sum("l_quantity").alias("qty"),
    )
    return bars.withColumns({c: F.when(several, F.col(c)) for c in ("last_line", "high", "low")})


def _whole_bars(bars: DataFrame) -> DataFrame:
    """:func:`_supplier_bars` with every bar's last line and prices."""
    one = F.col("lines") == 1
    price = F.col("first_line.l_extendedprice")
    return bars.withColumns({
        # before the whole lines, so that who needs prices alone reads no line's keys
        "open": price,
        "close": F.when(one, price).otherwise(F.col("last_line.l_extendedprice")),
        "high": F.when(one, price).otherwise(F.col("high")),
        "low": F.when(one, price).otherwise(F.col("low")),
        "last_line": F.when(one, F.col("first_line")).otherwise(F.col("last_line")),
    })


def supplier_symbol(key: str) -> Column:
    return F.concat(F.lit(SYMBOL_PREFIX), F.col(key).cast("string"))


def stock_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: symbol, datetime (date), open, high, low, close, volume.

    Supplier bars are aggregated from the line items once and staged as a
    parquet table in the shared folder (one row per supplier and day); the
    benchmark's bars are re-aggregated from those partials (min/max/sum are
    associative), so the line items are scanned and shuffled once, and staged
    too (a row per day).  The feed is a view of the two staged tables.
    """
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("datetime"), *BAR_LINE_ORDER, "l_quantity")
    stage = shared_path(spark, "supplier_bars")
    _supplier_bars(lines).write.mode("overwrite").parquet(stage)
    per_supplier = _whole_bars(spark.read.parquet(stage))

    def line(of: str) -> Column:
        return F.struct(*[F.col(c) if c == "l_suppkey" else F.col(f"{of}.{c}") for c in BAR_LINE_ORDER])

    benchmark = per_supplier.groupBy("datetime").agg(
        F.min(line("first_line")).alias("first_line"),
        F.max(line("last_line")).alias("last_line"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("qty").alias("qty"),
    ).select(
        F.lit(BENCHMARK_SYMBOL).alias("symbol"), "datetime",
        F.col("first_line.l_extendedprice").alias("open"), "high", "low",
        F.col("last_line.l_extendedprice").alias("close"), "qty")
    of_benchmark = shared_path(spark, "benchmark_bars")
    benchmark.write.mode("overwrite").parquet(of_benchmark)
    per_supplier = per_supplier.withColumn("symbol", supplier_symbol("l_suppkey"))
    cols = ["symbol", "datetime", "open", "high", "low", "close", "qty"]
    bars = per_supplier.select(*cols).unionByName(spark.read.parquet(of_benchmark).select(*cols))
    return bars.select(
        "symbol", "datetime", "open", "high", "low", "close", F.col("qty").cast("long").alias("volume"))


def news_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles: id, headline, datetime, category, source, related, summary, url, image."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    lineitem = read_table(spark, sf_dir, "lineitem").select(*ORDER_LINE_ORDER, "l_orderkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")

    # First line of each order: an aggregate keyed (and so partitioned) by the
    # order key, which the orders join below reuses without a second shuffle.
    # Outer joins run in the written order: order key, then customer.
    first_line = dealt(lineitem, "l_orderkey").groupBy("l_orderkey").agg(
        F.min(F.struct(*[F.col(c) for c in ORDER_LINE_ORDER])).alias("fl")
    ).select("l_orderkey", F.col("fl.l_suppkey").alias("first_suppkey"))
    with_line = orders.join(first_line, orders.o_orderkey == first_line.l_orderkey, "left")

    key = F.col("o_orderkey")
    key_txt = key.cast("string")
    return (
        with_line.join(customer, with_line.o_custkey == customer.c_custkey, "left")
        .select(
            key.alias("id"),
            F.when(key % NO_HEADLINE_EVERY == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit(HEADLINE_PREFIX), key_txt))
            .alias("headline"),
            F.col("o_orderdate").cast("timestamp").alias("datetime"),
            F.col("o_orderpriority").alias("category"),
            F.col("c_mktsegment").alias("source"),
            supplier_symbol("first_suppkey").alias("related"),
            F.concat(F.lit(SUMMARY_PREFIX), key_txt).alias("summary"),
            F.concat(F.lit(URL_PREFIX), key_txt).alias("url"),
            F.lit(None).cast("string").alias("image"),
        )
    )


def weather_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations in the feed's own column names (``date`` ... ``sunset``)."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice"
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation and region are fixed 25- and 5-row tables: safe to broadcast.
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "r_name"
    )
    located = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        F.broadcast(geo), F.col("c_nationkey") == geo.n_nationkey
    )
    day = located.groupBy(
        F.col("r_name").alias("city"), F.to_date("o_orderdate").alias("date")
    ).agg(
        (F.max("o_totalprice") / TEMP_DIVISOR).alias("max_temp"),
        (F.min("o_totalprice") / TEMP_DIVISOR).alias("min_temp"),
        (F.count_if(F.col("o_orderstatus") == "F") * PRECIP_PER_FINISHED).cast("double").alias("precip"),
        (F.count(F.lit(1)) * WIND_PER_ORDER).cast("double").alias("max_wind"),
    )
    unix_day = F.unix_date("date").cast("long")
    return day.select(
        "date",
        "city",
        "max_temp",
        "min_temp",
        "precip",
        "max_wind",
        (F.col("max_temp") - 1).alias("appt_max"),
        (F.col("min_temp") - 2).alias("appt_min"),
        ((F.col("max_temp") - 1) - (F.col("min_temp") - 2)).alias("appt_temp_range"),
        (F.col("max_temp") - F.col("min_temp")).alias("temp_range_c"),
        F.lit(DAYLIGHT_SECONDS).alias("daylight_duration"),
        (unix_day * 86400 + SUNRISE_SECONDS).alias("sunrise"),
        (unix_day * 86400 + SUNSET_SECONDS).alias("sunset"),
    )


def load_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "news": news_api(spark, sf_dir),
        "stocks": stock_api(spark, sf_dir),
        "weather": weather_api(spark, sf_dir),
    }


# Remainders of the volume by MESSY_EVERY that a messy record has, and
# the years' remainders by 3 whose records have other names, or a column more.
MESSY_EVERY = 50
BAD_DAY, BAD_CLOSE, NO_SYMBOL, NEGATIVE_VOLUME, CUT_OFF = range(5)
OTHER_NAMES, MORE_COLUMNS = 1, 2


def messy_stock_lines(bars: DataFrame) -> DataFrame:
    """The stock bars as lines of JSON text (``value``), as a feed that has changed
    over the years and has bad records: columns renamed, one added, days spelt
    in two ways; days and prices that are none, missing symbols, negative
    volumes, lines that break off."""
    messy = F.col("volume") % MESSY_EVERY
    shape = F.year("datetime") % 3
    symbol = F.when(messy != NO_SYMBOL, F.col("symbol"))
    day = F.when(messy == BAD_DAY, F.lit("n/a")).when(
        shape == OTHER_NAMES, F.date_format("datetime", "dd.MM.yyyy")
    ).otherwise(F.date_format("datetime", "yyyy-MM-dd"))
    close = F.when(messy == BAD_CLOSE, F.lit("1,5")).otherwise(F.col("close").cast("string"))
    volume = F.when(messy == NEGATIVE_VOLUME, -F.col("volume") - 1).otherwise(F.col("volume"))
    prices = [F.col(c) for c in ("open", "high", "low")] + [close.alias("close")]
    text = F.when(shape == OTHER_NAMES, F.to_json(F.struct(
        symbol.alias("ticker"), day.alias("date"), *prices, volume.alias("vol")
    ))).when(shape == MORE_COLUMNS, F.to_json(F.struct(
        symbol.alias("symbol"), F.lit("USD").alias("currency"), day.alias("datetime"), *prices,
        volume.alias("volume")
    ))).otherwise(F.to_json(F.struct(
        symbol.alias("symbol"), day.alias("datetime"), *prices, volume.alias("volume"))))
    whole = bars.select(messy.alias("messy"), text.alias("text"))
    cut = F.substring("text", F.lit(1), F.length("text") - 1)
    return whole.select(F.when(F.col("messy") == CUT_OFF, cut).otherwise(F.col("text")).alias("value"))


def replicate_symbols(feeds: dict[str, DataFrame], copies: int) -> dict[str, DataFrame]:
    """Scale-out copies of the stock and news feeds for benchmarks: every
    symbol ``s`` is kept and gets copies ``s~1 .. s~{copies-1}`` with the same
    bars, and every article is repeated once per copy with a distinct id and
    the copy's symbol (the benchmark symbol itself stays).  Weather is
    unchanged."""
    if copies <= 1:
        return feeds
    k = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("__copy")
    c = F.col("__copy")

    def renamed(col):
        return F.when(c == 0, F.col(col)).otherwise(F.concat(F.col(col), F.lit("~"), c.cast("string")))

    # copies are generated inside each input partition: spread the (small)
    # input first so the copies are produced in parallel
    n = int(feeds["stocks"].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stocks = feeds["stocks"].repartition(n).select("*", k)
    stocks = stocks.withColumn("symbol", renamed("symbol")).drop("__copy")
    news = feeds["news"].repartition(n).select("*", k)
    news = news.withColumn("id", F.col("id") * copies + c).withColumn(
        "related", renamed("related")
    ).drop("__copy")
    return {"stocks": stocks, "news": news, "weather": feeds["weather"]}
