"""Ordered per-key series whose largest key may not fit one task.

Window functions partitioned by a key move each key's rows into one task.
When the largest key is small (the usual case: one row per symbol per
trading day) that is what runs.  When a key holds more rows than
``chunk_rows`` -- a hot key -- its series is cut into chunks of
``chunk_rows`` consecutive rows instead:

* every row gets its 1-based position in its key's series, computed with the
  scalable global row number (range partitioning, no single task per key);
* chunk = (position - 1) div chunk_rows; the windows are partitioned by
  (key, chunk) and ordered by position;
* a chunk also receives copies ("halo" rows) of the ``back`` rows before it
  and the ``forward`` rows after it (a halo may span several chunks), so every bounded ROWS frame, lag and
  lead of an own row sees exactly the rows it would see in the whole series;
  halo rows are dropped after the windows;
* running aggregates from the series start (first value, running maximum)
  combine a per-chunk aggregate, prefix-combined over the chunks of a key
  (one row per chunk), with the running value inside the chunk.

Both ways order a series by one total order: the order column, then the
frame's remaining columns, nulls last.  So results don't depend on the chunk
size even where a key has several rows for one day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import running
from .dealing import SLOT
from .row_number import global_row_number

# Rows of one key processed by one window task before the series is chunked.
DEFAULT_CHUNK_ROWS = 1_000_000
_HELPERS = ("__g", "__pos", "__chunk", "__halo")


def largest_key(df: DataFrame, key: str) -> int:
    """Row count of the largest key (one aggregate row to the driver)."""
    row = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("m")).first()
    return int(row["m"] or 0)


def positions(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``__pos``: 1-based position of each row in its key's series by ``order``,
    without one task per key."""
    numbered = global_row_number(df, [key, *order], out_col="__g", tiebreak=False)
    starts = numbered.groupBy(key).agg(F.min("__g").alias("__start"))
    starts = starts.withColumnRenamed(key, "__key")
    j = numbered.join(starts, numbered[key].eqNullSafe(starts["__key"]))
    return j.withColumn("__pos", F.col("__g") - F.col("__start") + 1).drop("__key", "__start")


@dataclass
class Series:
    """A frame prepared for per-key windows: ``part`` / ``order`` are the
    window partition and order columns to use."""

    df: DataFrame
    key: str
    part: list[str]
    order: list[str]
    chunked: bool

    def with_first(self, df: DataFrame, value: str, out: str) -> DataFrame:
        """``first_value(value)`` over the key's series (from its first row)."""
        if not self.chunked:
            return df.withColumn(out, F.first(value).over(running(self.part, self.order)))
        firsts = df.filter((F.col("__pos") == 1) & ~F.col("__halo")).select(
            F.col(self.key).alias("__key"), F.col(value).alias(out)
        )
        return df.join(firsts, df[self.key].eqNullSafe(firsts["__key"]), "left").drop("__key")

    def with_running_max(self, df: DataFrame, value: str, out: str) -> DataFrame:
        """``max(value)`` from the series start to the current row."""
        inside = F.max(value).over(running(self.part, self.order))
        if not self.chunked:
            return df.withColumn(out, inside)
        per_chunk = (
            df.filter(~F.col("__halo"))
            .groupBy(self.key, "__chunk")
            .agg(F.max(value).alias("__cmax"))
        )
        before = Window.partitionBy(self.key).orderBy("__chunk").rowsBetween(
            Window.unboundedPreceding, -1
        )
        prefix = per_chunk.select(
            F.col(self.key).alias("__key"),
            F.col("__chunk").alias("__c"),
            F.max("__cmax").over(before).alias("__prefix"),
        )
        j = df.join(
            prefix,
            df[self.key].eqNullSafe(prefix["__key"]) & (df["__chunk"] == prefix["__c"]),
            "left",
        )
        # halo rows come from the previous chunk, already inside the prefix
        return j.withColumn(out, F.greatest(F.col("__prefix"), inside)).drop(
            "__key", "__c", "__prefix"
        )

    def own(self, df: DataFrame) -> DataFrame:
        """Drop halo copies and helper columns after the windows."""
        if not self.chunked:
            return df
        return df.filter(~F.col("__halo")).drop(*_HELPERS)


def prepare(
    df: DataFrame,
    key: str,
    order: str = "date_key",
    back: int = 0,
    forward: int = 0,
    chunk_rows: int | None = DEFAULT_CHUNK_ROWS,
    force: bool = False,
    largest: int | None = None,
) -> Series:
    """Plain per-key windows when every key fits ``chunk_rows``; chunked
    series with ``back``/``forward`` halo rows otherwise.

    ``largest`` is the size of the largest key when the caller knows it (for
    instance from the table the frame derives from); the choice only sizes
    tasks, results are the same either way.  Rows that were dealt to slots
    (``dealing.dealt_to``) stay in them while their series aren't chunked.
    """
    total = [order, *[c for c in df.columns if c not in (key, order, SLOT)]]
    part = [c for c in (SLOT, key) if c in df.columns]
    if chunk_rows is None:
        return Series(df, key, part, total, False)
    if not force:
        if largest is None:
            largest = largest_key(df, key)
        if largest <= chunk_rows:
            return Series(df, key, part, total, False)
    pos = positions(df.drop(SLOT), key, total)
    p = F.col("__pos")
    k = ((p - 1) / chunk_rows).cast("long")
    own = pos.withColumn("__chunk", k).withColumn("__halo", F.lit(False))
    parts = [own]
    if back:
        # a row is context for every later chunk whose first row is at most
        # `back` rows after it: chunks k+1 .. floor((p - 1 + back) / C)
        last = F.floor((p - 1 + back) / chunk_rows).cast("long")
        parts.append(
            pos.filter(last >= k + 1)
            .withColumn("__chunk", F.explode(F.sequence(k + 1, last)))
            .withColumn("__halo", F.lit(True))
        )
    if forward:
        # ... and for every earlier chunk whose last row is at most `forward`
        # rows before it: chunks max(ceil((p - forward) / C) - 1, 0) .. k-1
        first = F.greatest(F.ceil((p - forward) / chunk_rows).cast("long") - 1, F.lit(0).cast("long"))
        parts.append(
            pos.filter(first <= k - 1)
            .withColumn("__chunk", F.explode(F.sequence(first, k - 1)))
            .withColumn("__halo", F.lit(True))
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return Series(out, key, [key, "__chunk"], ["__pos"], True)
