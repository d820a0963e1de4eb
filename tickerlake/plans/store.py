"""Stored warehouse whose window marts follow its loads.

A load brings bars, new and corrected ones.  What it changes is worked out once
(the delta: bars that the stored fact doesn't have as they are), and every table
behind the fact is brought up to date from the delta:

* the fact's touched months are merged;
* the month states of the touched months are computed anew;
* the delta's stocks are added to the bitmaps of stocks by day;
* the benchmark's series is computed anew from its first changed day;
* each stock's features are computed anew from its first changed day, where a
  changed benchmark changes every stock.  A stock's rows are read from the month
  that holds the 49 bars before that day (the longest frame), which the month
  states tell, and its first and largest close before those come from the states
  too.  Months that no stock needs are not read.

Every table is switched through its ledger, and a load is recorded before its
first switch and taken out after its last: a load that broke off is applied again
by the next one, from the same delta.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import date_key
from ..operators import bitmaps, moments, series
from ..operators.dealing import dealt, sent_if_small
from ..operators.ledger import (
    PART_COL, Files, finish, read_table, replace_months, stage_months, switch,
)
from ..operators.upsert import merge, one_per_key, stable_stock_keys
from ..sources.fixtures import BENCHMARK_SYMBOL
from ..sources.raw import load_order
from . import features, warehouse

KEY = ["stock_key", "date_key"]
#: Bars before a row that its longest frame reaches back to, and those of the benchmark's.
HALO = 49
INDEX_HALO = 20


class MarketStore:
    """Fact, month states, stocks by day, benchmark series and price features under
    one folder."""

    def __init__(self, spark: SparkSession, root: str, benchmark: str = BENCHMARK_SYMBOL,
                 chunk_rows: int | None = series.DEFAULT_CHUNK_ROWS):
        self.spark, self.root, self.benchmark = spark, root.rstrip("/"), benchmark
        self.chunk_rows = chunk_rows
        self.files = Files(spark, self.root)

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        """A stored table: dim, fact, states, tracked, index, features."""
        df = read_table(self.spark, self._path(name))
        if df is None:
            raise ValueError(f"no load has written {name} yet")
        return df

    # -- loads -----------------------------------------------------------
    def load(self, raw_stocks: DataFrame) -> None:
        """Load bars: each replaces the stored bar of its stock and day.  Of several
        for one key the last by the feed's load sequence, if it has one, else the
        largest by its columns.  A load without changes writes nothing."""
        self.recover()
        dim = stable_stock_keys(self.spark, raw_stocks, self._path("dim"))
        seq = load_order(raw_stocks)
        cols = warehouse.FACT_COLS
        batch = one_per_key(warehouse.fact_stock(raw_stocks, dim, seq), KEY, seq).select(*cols)
        staged = self._path(f"_loads/{uuid.uuid4().hex}")
        fact = read_table(self.spark, self._path("fact"))
        if fact is not None:
            feed_days = raw_stocks.select(date_key("datetime").alias("date_key")).dropna()
            old = fact.filter(F.col(PART_COL).isin(self._months(feed_days))).select(
                F.struct(*cols).alias("old"), *[F.col(c).alias(f"of_{c}") for c in KEY])
            # by the key alone, by which the batch is dealt already; the fact has it once
            same = [F.col(c) == F.col(f"of_{c}") for c in KEY]
            changed = F.col("of_stock_key").isNull() | ~F.struct(*cols).eqNullSafe(F.col("old"))
            batch = batch.join(old, same, "left").filter(changed).select(*cols)
        batch.write.parquet(f"{staged}/delta")
        self.files.write(self._path("_open.json"), json.dumps({"staged": staged}))
        self.recover()

    def recover(self) -> bool:
        """Apply a load that is recorded as open; whether there was one."""
        if not self.files.exists(self._path("_open.json")):
            return False
        staged = json.loads(self.files.read(self._path("_open.json")))["staged"]
        delta = read_table(self.spark, f"{staged}/delta")
        if delta is not None and not delta.isEmpty():
            self._apply(delta)
        self.files.delete(self._path("_open.json"))
        self.files.delete(staged)
        return True

    def _apply(self, delta: DataFrame) -> None:
        months = self._months(delta)
        merge(self.spark, delta, self._path("fact"), KEY)
        fact = self.table("fact").filter(F.col(PART_COL).isin(months))
        replace_months(self.spark, moments.month_states(fact), self._path("states"))
        tracked = self._path("tracked")
        behind = read_table(self.spark, tracked) is None  # the first load, or a store without bitmaps
        bitmaps.add_days(self.spark, self.table("fact") if behind else delta, tracked, "stock_key")
        self._features(delta, self._index(delta))

    @staticmethod
    def _months(rows: DataFrame) -> list[int]:
        """Months of some bars (bounded by the calendar)."""
        month = (F.col("date_key") / 100).cast("int")
        return sorted(r["m"] for r in rows.select(month.alias("m")).distinct().collect())

    # -- what follows the fact -------------------------------------------
    def needed_months(self, first: DataFrame, halo: int) -> DataFrame:
        """``stock_key, month_key`` to read for rows ``stock_key, first`` (the first
        changed day), with the first and the largest close before those months.

        All months from that day on, and before it so many that they hold ``halo``
        bars, or all there are."""
        month = (F.col("first") / 100).cast("int")
        s = self.table("states").join(first, "stock_key").select(
            "stock_key", PART_COL, "n", "first_close", "max_close",
            (F.col(PART_COL) < month).alias("past"))
        back = Window.partitionBy("stock_key").orderBy(F.desc(PART_COL))
        nearer = F.sum(F.when(F.col("past"), F.col("n")).otherwise(0)).over(
            back.rowsBetween(Window.unboundedPreceding, -1))
        s = s.withColumn("needed", ~F.col("past") | (F.coalesce(nearer, F.lit(0)) < halo))
        whole = Window.partitionBy("stock_key")
        far = ~F.col("needed")
        return s.withColumns({
            "carried_max": F.max(F.when(far, F.col("max_close"))).over(whole),
            "carried_first": F.min_by(F.when(far, F.col("first_close")),
                                      F.when(far, F.col(PART_COL))).over(whole),
        }).filter("needed").select("stock_key", PART_COL, "carried_max", "carried_first")

    def rows_to_read(self, first: DataFrame, halo: int) -> DataFrame:
        """Fact rows of the needed months; other months are not read.  A stock's needed
        months are all from one on, so it meets its rows by its key alone."""
        needed = self._stage(self.needed_months(first, halo).groupBy("stock_key").agg(
            F.min(PART_COL).alias("from_month"),
            *[F.max(c).alias(c) for c in ("carried_max", "carried_first")]), "needed")
        own = self.table("states").join(needed, "stock_key").filter(
            F.col(PART_COL) >= F.col("from_month"))
        months = sorted(r[PART_COL] for r in own.select(PART_COL).distinct().collect())
        fact = self.table("fact").filter(F.col(PART_COL).isin(months))
        return fact.join(sent_if_small(needed), "stock_key").filter(
            F.col(PART_COL) >= F.col("from_month")).drop("from_month")

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        path = self._path(f"_loads/{name}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _index(self, delta: DataFrame) -> int | None:
        """Bring the benchmark's series up to date; its first changed day, if any."""
        dim = self.table("dim")
        key = dim.filter(F.col("symbol") == self.benchmark).select("stock_key")
        first = delta.join(key, "stock_key").groupBy("stock_key").agg(
            F.min("date_key").alias("first"))
        row = first.first()  # one stock
        if row is None:
            return None
        rows = self.rows_to_read(self.spark.createDataFrame([tuple(row)], first.schema), INDEX_HALO)
        new = features.index_series(
            features.stock_base(rows, dim), self.benchmark, chunk_rows=self.chunk_rows)
        merge(self.spark, self._stage(new.filter(F.col("date_key") >= row["first"]), "index"),
              self._path("index"), ["date_key"])
        return row["first"]

    def _features(self, delta: DataFrame, index_day: int | None) -> None:
        first = delta.groupBy("stock_key").agg(F.min("date_key").alias("first"))
        if index_day is not None:
            behind = self.table("states").groupBy("stock_key").agg(
                F.max("last_day").alias("last")).filter(F.col("last") >= index_day)
            first = first.unionByName(behind.select(
                "stock_key", F.lit(index_day).cast("int").alias("first")
            )).groupBy("stock_key").agg(F.min("first").alias("first"))
        first = self._stage(first, "first")
        index = read_table(self.spark, self._path("index"))
        if index is None:  # no benchmark bar yet
            index = self.spark.createDataFrame(
                [], "date_key int, index_return double, index_var_20 double, "
                    "index_rolling_return_20 double")
        # dealt before more columns are added; the windows need no other shuffle
        rows, dim = dealt(self.rows_to_read(first, HALO), "stock_key"), self.table("dim")
        new = features.price_features(
            features.stock_base(rows, dim), index, chunk_rows=self.chunk_rows)
        new = new.join(first, "stock_key").filter(F.col("date_key") >= F.col("first"))
        self._put_features(new.select(*features.PRICE_STORED_COLS), first)

    def _put_features(self, new: DataFrame, first: DataFrame) -> None:
        """Features in place of all of their stocks' from ``first`` on.

        The rows that stay are told by their stock's first day, so the new ones needn't
        be written before to compare keys, and nothing is shuffled by month: each task
        writes its stocks' rows, or those it read of a month, into their months."""
        path = self._path("features")
        finish(self.spark, path)
        stored = read_table(self.spark, path)
        if stored is not None:
            month = (F.col("first") / 100).cast("int")
            touched = self.table("states").join(first, "stock_key").filter(F.col(PART_COL) >= month)
            months = [r[PART_COL] for r in touched.select(PART_COL).distinct().collect()]
            since = first.withColumnRenamed("stock_key", "of")
            replaced = (F.col("stock_key") == F.col("of")) & (F.col("date_key") >= F.col("first"))
            stay = stored.filter(F.col(PART_COL).isin(months)).join(
                sent_if_small(since), replaced, "left_anti")
            new = stay.select(*features.PRICE_STORED_COLS).unionByName(new)
        switch(self.spark, path, stage_months(new, path, deal=False))

    # -- marts -----------------------------------------------------------
    def price_features(self) -> DataFrame:
        finish(self.spark, self._path("features"))
        return features.with_derived(self.table("features"))

    def fact_stock(self) -> DataFrame:
        return self.table("fact").select(*warehouse.FACT_COLS)

    def stocks_tracked(self) -> DataFrame:
        """Distinct stocks with a bar on every day, in every month and year."""
        finish(self.spark, self._path("tracked"))
        return bitmaps.counts_by_span(self.table("tracked"), "stocks_tracked")

    def symbol_profile(self) -> DataFrame:
        return moments.symbol_profile(self.table("states"), self.table("dim"))

    def volatility_metrics(self) -> DataFrame:
        return moments.volatility_metrics(self.table("states"), self.table("dim"))
