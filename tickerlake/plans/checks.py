"""Data-quality checks that follow loads.

``CheckStore`` keeps, under one folder, what the checks of every table need: the
failures of its not-null and positivity checks per load (they add up), and a key
index per uniqueness, grain and relationship check.  A load looks at its own rows
and at the index slots of its keys, never at the rows of the loads before.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import key_index, quality
from ..operators.ledger import read_table
from ..session import shared_path

# Keys that should identify one row each, child and parent columns, and
# the last days of the first and the second of three replayed loads.
GRAINS = [("raw_stocks", ["symbol", "datetime"]), ("raw_weather", ["city", "raw_date"])]
LINKS = [("raw_news", "related", "dim_stock", "symbol"), ("raw_stocks", "symbol", "dim_stock", "symbol")]
UNTIL = ("1994-12-31", "1996-12-31")
LOAD_DAYS = {"raw_stocks": "datetime", "raw_news": "datetime", "raw_weather": "raw_date"}


class CheckStore:
    """Checks of several tables, kept up to date by ``load``.

    ``checks`` as in ``quality``; ``grains`` are (table, columns); ``links`` are
    (child table, child column, parent table, parent column)."""

    def __init__(self, spark: SparkSession, root: str, checks=(), grains=(), links=(),
                 slots: int = key_index.SLOTS):
        self.spark, self.root, self.slots = spark, root.rstrip("/"), slots
        self.checks, self.grains, self.links = list(checks), list(grains), list(links)

    def _index(self, name: str, columns: list[str], **how) -> key_index.KeyIndex:
        return key_index.KeyIndex(self.spark, f"{self.root}/index/{name}", columns,
                                  slots=self.slots, **how)

    def _unique(self, c: quality.Check) -> key_index.KeyIndex:
        return self._index(f"unique.{c.table}.{c.column}", [c.column])

    def _grain(self, table: str, columns: list[str]) -> key_index.KeyIndex:
        return self._index(f"grain.{table}.{'.'.join(columns)}", columns, nulls=True)

    def _link(self, child: str, col: str, parent: str, pcol: str) -> key_index.KeyIndex:
        return self._index(f"link.{child}.{col}.{parent}.{pcol}", [col],
                           kind=key_index.RELATIONSHIP)

    def load(self, load: str, table: str, rows: DataFrame) -> None:
        """Check a load's rows.  The load's name stands for these rows of this table: a
        load that is repeated, after it broke off or was done, is counted once."""
        scalar = [c for c in self.checks if c.table == table and c.check != "unique"]
        if scalar:
            quality.check_table(rows, scalar).write.mode("overwrite").parquet(
                f"{self.root}/counted/{table}/{load}")
        for c in self.checks:
            if c.table == table and c.check == "unique":
                self._unique(c).add(load, rows)
        for of, columns in self.grains:
            if of == table:
                self._grain(of, columns).add(load, rows)
        for child, col, parent, pcol in self.links:
            if child == table:
                self._link(child, col, parent, pcol).add(
                    f"{load}.children", rows, [col], key_index.CHILDREN)
            if parent == table:
                self._link(child, col, parent, pcol).add(
                    f"{load}.parents", rows, [pcol], key_index.PARENTS)

    def report(self) -> DataFrame:
        """``table_name, column_name, check_name, failures`` over all loads."""
        scalar = [c for c in self.checks if c.check != "unique"]
        names = self.spark.createDataFrame(
            [(c.table, c.column, c.check) for c in scalar],
            "table_name string, column_name string, check_name string")
        parts = []
        for table in sorted({c.table for c in scalar}):
            counted = read_table(self.spark, f"{self.root}/counted/{table}/*")
            if counted is not None:
                parts.append(counted)
        out = names.withColumn("failures", F.lit(0).cast("long"))
        for p in parts:
            out = out.unionByName(p)
        out = out.groupBy("table_name", "column_name", "check_name").agg(
            F.sum("failures").alias("failures"))
        kept = [(c.table, c.column, "unique", self._unique(c)) for c in self.checks
                if c.check == "unique"]
        kept += [(t, ",".join(cols), "unique_combination", self._grain(t, cols))
                 for t, cols in self.grains]
        kept += [(link[0], link[1], "relationships", self._link(*link)) for link in self.links]
        for table, column, check, index in kept:
            out = out.unionByName(index.failures().select(
                F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                F.lit(check).alias("check_name"), "failures"))
        return out


def incremental_quality(build) -> DataFrame:
    """The source checks, grains and links after three loads of the feeds by day.

    News of a span come before its bars, and so before the stocks that they are
    about; the second load is sent twice."""
    store = CheckStore(build.spark, shared_path(build.spark, "check_store"),
                       quality.SOURCE_CHECKS, GRAINS, LINKS)
    feeds = {"raw_news": build.raw_news, "raw_stocks": build.raw_stocks,
             "raw_weather": build.raw_weather}
    first, second = (F.lit(dt.date.fromisoformat(d)) for d in UNTIL)
    for k in (0, 1, 1, 2):
        for table, feed in feeds.items():
            day = F.to_date(LOAD_DAYS[table])
            part = [F.coalesce(day <= first, F.lit(False)),
                    (day > first) & (day <= second),
                    F.coalesce(day > second, F.lit(True))][k]
            store.load(f"load-{k}", table, feed.filter(part))
            if table == "raw_stocks":
                # stocks that this load brings: one that came before is another row
                # of the same parent, which a relationship doesn't mind
                store.load(f"load-{k}", "dim_stock", feed.filter(part).select("symbol").distinct())
    return store.report()
