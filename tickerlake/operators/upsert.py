"""Incremental tables: high-water-mark loads and keyed upserts on parquet.

A stored table is parquet partitioned by month of ``date_key``.  A load

1. reads the target's high-water mark (one aggregate row),
2. keeps the feed's rows past it, compared on the feed's own date column so
   that the scan skips older files and row groups (``newer_rows``; with
   ``lookback_days`` the last days are read again so late rows and corrections
   are merged too; an empty or missing target loads everything),
3. reduces them to one row per unique key and stages them once,
4. replaces target rows that share the key with a staged row and inserts the
   rest -- only inside the months that the staged rows touch,
5. writes the merged months once, beside the table, and switches them by a
   ledger (``ledger``), so no job reads and overwrites the same files and a load
   that breaks off is finished by the next one.

Stable surrogate keys: symbols already in a stored dimension keep their key;
new symbols are numbered after the current maximum and appended.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .ledger import PART_COL, Files, finish, read_table, stage_months, switch
from .row_number import dense_keys, global_row_number


def high_water_mark(target: DataFrame, col: str = "date_key"):
    """``select max(col) from target`` as a Python scalar (one aggregate row).

    On a month-partitioned table the newest month comes from the partition
    values first, so only that month's files are read for the maximum day.
    """
    if col == "date_key" and PART_COL in target.columns:
        month = target.agg(F.max(PART_COL).alias("m")).first()["m"]
        if month is None:
            return None
        target = target.filter(F.col(PART_COL) == F.lit(month))
    return target.agg(F.max(col).alias("hwm")).first()["hwm"]


def _shift_key(key: int, days: int) -> int:
    d = dt.date(key // 10000, key // 100 % 100, key % 100) - dt.timedelta(days=days)
    return d.year * 10000 + d.month * 100 + d.day


def newer_rows(
    feed: DataFrame, date_col: str, target: DataFrame | None, lookback_days: int | None = None
) -> DataFrame:
    """Rows of a feed past the target's high-water mark, by the feed's date or
    timestamp column: a plain comparison with a literal, which reaches the scan."""
    hwm = None if target is None else high_water_mark(target)
    if hwm is None:
        return feed
    from_key = _shift_key(int(hwm), lookback_days or -1)
    day = dt.date(from_key // 10000, from_key // 100 % 100, from_key % 100)
    return feed.filter(F.col(date_col) >= F.lit(day))


def incoming_rows(
    source: DataFrame, target: DataFrame | None, col: str = "date_key", lookback_days: int | None = None
) -> DataFrame:
    """Rows of ``source`` past the target's high-water mark, by the key itself."""
    if target is None:
        return source
    hwm = high_water_mark(target, col)
    if hwm is None:
        return source
    if lookback_days:
        return source.filter(F.col(col) >= F.lit(_shift_key(int(hwm), lookback_days)))
    return source.filter(F.col(col) > F.lit(hwm))


def one_per_key(rows: DataFrame, unique_key: list[str], load_order: list[str] | None = None) -> DataFrame:
    """One row per key: the last by ``load_order``, then the largest by the remaining
    columns in their order (nulls smallest).  A partial aggregate, so a key
    with very many rows is reduced before the shuffle."""
    first = load_order or []
    rest = [c for c in rows.columns if c not in unique_key and c not in first]
    value = F.struct(*first, *rest)
    return (
        rows.groupBy(*unique_key).agg(F.max(value).alias("__row"))
        .select(*[F.col(c) if c in unique_key else F.col(f"__row.{c}").alias(c) for c in rows.columns])
    )


def merge(
    spark: SparkSession, batch: DataFrame, target_path: str, unique_key: list[str]
) -> list[int]:
    """Merge a stored batch of one row per key into the table; returns its months.

    Inside the touched months the target's rows that share a key are replaced and
    the others kept; no other month is read.  The merged months are written once
    and switched through the ledger (``ledger``)."""
    finish(spark, target_path)
    target = read_table(spark, target_path)
    cols = batch.columns
    if target is not None:
        # the months a load touches are few (bounded by the calendar): list them
        # so the target read is pruned to those partitions
        month = (F.col("date_key") / 100).cast("int")
        months = [r["m"] for r in batch.select(month.alias("m")).distinct().collect()]
        old = target.filter(F.col(PART_COL).isin(months)).select(*cols)
        # keys of months that the table doesn't have replace nothing
        stored = Files(spark, target_path).names(target_path)
        both = [m for m in months if f"{PART_COL}={m}" in stored]
        keys = batch.filter(month.isin(both)).select(*unique_key)
        batch = old.join(keys, unique_key, "left_anti").select(*cols).unionByName(batch)
        if not months:
            return []
    return switch(spark, target_path, stage_months(batch, target_path))


def upsert(
    spark: SparkSession,
    source: DataFrame,
    target_path: str,
    unique_key: list[str],
    lookback_days: int | None = None,
    high_water: bool = True,
    load_order: list[str] | None = None,
) -> DataFrame:
    """Load ``source`` into the table at ``target_path``; return the table.

    ``high_water=False`` merges every row of ``source`` on the unique key,
    whatever the table's last day (micro-batches, feeds filtered before).  Of
    several rows with one key the last by ``load_order`` is loaded, of such ties
    the largest by the remaining columns; the load order is not stored.  A load
    without rows changes nothing: a table that doesn't exist still doesn't, and
    an empty frame is returned.
    """
    cols = [c for c in source.columns if c not in (load_order or [])]
    finish(spark, target_path)
    target = read_table(spark, target_path)
    if high_water:
        source = incoming_rows(source, target, lookback_days=lookback_days)
    incoming = one_per_key(source, unique_key, load_order).select(*cols)
    if target is None:
        switch(spark, target_path, stage_months(incoming, target_path))
    else:
        batch_path = shared_path(spark, "batch")
        incoming.write.parquet(batch_path)
        merge(spark, spark.read.schema(incoming.schema).parquet(batch_path), target_path, unique_key)
    stored = read_table(spark, target_path)
    return spark.createDataFrame([], incoming.schema) if stored is None else stored.select(*cols)


def stable_stock_keys(spark: SparkSession, raw_stocks: DataFrame, dim_path: str) -> DataFrame:
    """DIM_STOCK with keys that survive reloads.

    First load: dense rank of the symbols.  Later loads: stored keys are kept
    and unseen symbols get ``max(stock_key) + their rank among the new ones``.
    """
    current = read_table(spark, dim_path)
    if current is None:
        first = dense_keys(raw_stocks, "symbol", "stock_key")
        if first.isEmpty():  # nothing is stored for a load without rows
            return first
        first.write.mode("overwrite").parquet(dim_path)
        return spark.read.parquet(dim_path)
    base = current.agg(F.max("stock_key").alias("m")).first()["m"] or 0
    seen = current.select(F.col("symbol").alias("known"))
    symbols = raw_stocks.select("symbol").distinct()
    # NULL-safe: a NULL symbol already in the dimension is not new again.
    new = symbols.join(seen, symbols.symbol.eqNullSafe(seen.known), "left_anti")
    if not new.take(1):  # usual case: no new symbol, the stored dimension stands
        return current
    numbered = global_row_number(new, ["symbol"], out_col="rank", tiebreak=False)
    added = numbered.select((F.col("rank") + F.lit(base)).cast("long").alias("stock_key"), "symbol")
    # appended, never rewritten: a load that breaks off leaves the stored keys as they were
    added.write.mode("append").parquet(dim_path)
    return spark.read.parquet(dim_path)
