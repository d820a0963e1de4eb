"""Top-k lists per day that follow loads.

The list of a day is its first ``k`` rows in a total order (the stated columns, then
the key).  A load brings rows, new ones and such that replace stored ones by their
key, and its days' lists are worked out from the lists and the load:

* rows that weren't listed rank after the list's last row, so what ranks up to that
  row among the listed rows that were not replaced and the load's rows is certain;
* a day with ``k`` certain rows, or one whose list was shorter than ``k`` (it held
  the whole day), has its new list;
* the other days lost listed rows that the load doesn't make up for, and are listed
  anew from the table behind, of which only their months are read.

A list over a longer span is the first ``k`` of its days' lists.  Every ranking is
limited to ``k`` rows before the shuffle (a window with a rank limit), so a day that
holds most rows sends ``k`` rows per task.  Lists are switched by month through the
ledger; a load applied twice changes nothing.  Deleted rows need their day listed
anew (``rebuild``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path
from .dealing import sent_if_small
from .ledger import PART_COL, finish, read_table, replace_months

DAY, LAST, AHEAD, RANK = "date_key", "__list_end", "__ends_ahead", "__list_rank"


class KeptTop:
    """The first ``k`` rows of each ``date_key`` under ``path``.

    ``order`` are (column, descending) pairs, nulls last either way; ``key`` names
    the columns that identify a row, ``date_key`` among them.  ``k`` is at most
    1,000, the most that a window limits before its shuffle."""

    def __init__(self, spark: SparkSession, path: str, k: int, order: list[tuple[str, bool]],
                 key: list[str]):
        if not 1 <= k <= 1000:
            raise ValueError(f"k is {k}, not 1 to 1000")
        if DAY not in key:
            raise ValueError(f"{DAY} must be in the key")
        self.spark, self.path, self.k, self.key = spark, path.rstrip("/"), k, key
        self.order = order + [(c, False) for c in key if c not in [n for n, _ in order]]

    def ordering(self) -> list[Column]:
        return [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last()
                for c, down in self.order]

    def first(self, rows: DataFrame, by: list[str] | None = None) -> DataFrame:
        """The first ``k`` rows of each group (a day unless stated)."""
        w = Window.partitionBy(*(by or [DAY])).orderBy(*self.ordering())
        return rows.withColumn(RANK, F.row_number().over(w)).filter(
            F.col(RANK) <= self.k).drop(RANK)

    def lists(self) -> DataFrame | None:
        """All lists; None before the first row."""
        finish(self.spark, self.path)
        return read_table(self.spark, self.path)

    def over_all(self) -> DataFrame | None:
        """The first ``k`` of all days: sorted and limited, from the lists alone."""
        lists = self.lists()
        return None if lists is None else lists.drop(PART_COL).orderBy(*self.ordering()).limit(self.k)

    def _stored(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @staticmethod
    def _months(days: DataFrame) -> list[int]:
        """Months of some days (bounded by the calendar)."""
        month = (F.col(DAY) / 100).cast("int")
        return sorted(r["m"] for r in days.select(month.alias("m")).distinct().collect())

    def rebuild(self, table: DataFrame, days: DataFrame) -> DataFrame:
        """Lists of some days from the table behind; only their months are read."""
        months = self._months(days)
        if PART_COL in table.columns:
            table = table.filter(F.col(PART_COL).isin(months)).drop(PART_COL)
        return self.first(table.join(F.broadcast(days), DAY, "left_semi"))

    def certain(self, lists: DataFrame, load: DataFrame) -> tuple[DataFrame, DataFrame]:
        """New lists of the load's days as far as they are certain, and the days that
        must be listed anew.  ``lists`` are those of the load's months, stored."""
        cols = load.columns
        n = F.count(F.lit(1)).over(Window.partitionBy(DAY))
        end = F.row_number().over(Window.partitionBy(DAY).orderBy(*self.ordering())) == self.k
        ends = lists.withColumn(LAST, end & (n >= self.k)).filter(LAST)
        # a load is large against the lists: the lists' keys go to its rows
        replaced = load.select(*self.key).join(
            sent_if_small(lists.select(*self.key)), self.key, "left_semi")
        rest = lists.join(replaced, self.key, "left_anti").select(*cols)
        known = rest.unionByName(self.first(load)).withColumn(LAST, F.lit(False)).unionByName(
            ends.select(*cols, LAST))
        # an equal row counts as ahead of the list's end: the end itself was replaced by it
        order = Window.partitionBy(DAY).orderBy(*self.ordering(), F.col(LAST).asc())
        known = known.withColumn(AHEAD, F.count_if(F.col(LAST)).over(
            order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        known = self._stored(known.filter(~F.col(LAST) & (F.col(AHEAD) == 0)).drop(LAST, AHEAD), "certain")
        short = lists.groupBy(DAY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= self.k).select(
            DAY).join(load.select(DAY).distinct(), DAY, "left_semi")
        enough = known.groupBy(DAY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= self.k)
        anew = self._stored(short.join(enough, DAY, "left_anti"), "anew")
        return self.first(known.join(F.broadcast(anew), DAY, "left_anti")), anew

    def apply(self, load: DataFrame, table: DataFrame) -> int:
        """Bring the lists up to date after a load; returns how many days were listed
        anew.  ``load`` holds one row per key and is read several times (stored);
        ``table`` is the table behind with the load in it.  Days are bounded by the
        calendar, so sets of days are broadcast."""
        cols = load.columns
        lists = self.lists()
        if lists is None:
            replace_months(self.spark, self.first(table.select(*cols)), self.path)
            return 0
        lists = lists.filter(F.col(PART_COL).isin(self._months(load))).select(*cols)
        days = load.select(DAY).distinct()
        mine = lists.join(F.broadcast(days), DAY, "left_semi")
        new, anew = self.certain(mine, load)
        out = lists.join(F.broadcast(days), DAY, "left_anti").unionByName(new)
        n = anew.count()
        if n:
            keep = [*cols, *([PART_COL] if PART_COL in table.columns else [])]
            out = out.unionByName(self.rebuild(table.select(*keep), anew).select(*cols))
        replace_months(self.spark, out, self.path)
        return n
