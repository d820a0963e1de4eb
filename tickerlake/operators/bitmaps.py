"""Exact distinct counts of surrogate keys that merge over loads and over spans.

A state is a bitmap of the keys present in a group, cut into buckets of 32,768
keys: one row of fixed size (4 KB) per group and bucket that has keys, so a group
of very many keys is many small rows.  Bitmaps are united by OR, so a load's rows
are added without reading the rows before it, applying a load twice changes
nothing, and the count over a longer span is that of the united bitmaps, which
sums of counts are not.  All of it is plain aggregation: no row is expanded per
distinct count.  Keys are dealt by group and bucket, a few bytes each, and bitmaps
made after that: made before, every task would send one of 4 KB per group and
bucket it has seen, which grows with tasks times groups.

Keys must be non-negative integers and dense for this to be small (surrogate keys
are); null keys are in no bitmap.  Rows are only ever added: a key that
leaves a group needs the group's states built anew (``key_bitmaps``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .dealing import dealt
from .ledger import PART_COL, finish, read_table, replace_months

BUCKET, BITS = "bucket", "bits"


def key_bitmaps(rows: DataFrame, by: list[str], key: str) -> DataFrame:
    """``by, bucket, bits``: the keys present in each group."""
    bits = rows.filter(F.col(key).isNotNull()).select(
        *by, F.bitmap_bucket_number(key).alias(BUCKET), F.bitmap_bit_position(key).alias("bit"))
    return dealt(bits, *by, BUCKET).groupBy(*by, BUCKET).agg(
        F.bitmap_construct_agg("bit").alias(BITS))


def united(states: DataFrame, by: list[str | Column]) -> DataFrame:
    """States of coarser groups (or of the same, from several loads)."""
    return states.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_keys(states: DataFrame, by: list[str | Column], out: str = "distinct_keys") -> DataFrame:
    """Exact number of distinct keys in each group of ``by``."""
    names = [c for c in united(states, by).columns if c not in (BUCKET, BITS)]
    return united(states, by).groupBy(*names).agg(
        F.sum(F.bitmap_count(BITS)).cast("long").alias(out))


def add_days(spark: SparkSession, rows: DataFrame, target_path: str, key: str) -> list[int]:
    """Unite rows (``date_key`` and the key) with the stored states by day; returns
    the months touched.  Of the stored states only those months are read, of the
    rows behind them none."""
    finish(spark, target_path)
    new = key_bitmaps(rows, ["date_key"], key)
    stored = read_table(spark, target_path)
    if stored is not None:
        # months of a load, bounded by the calendar
        month = (F.col("date_key") / 100).cast("int")
        months = [r["m"] for r in rows.select(month.alias("m")).distinct().collect()]
        old = stored.filter(F.col(PART_COL).isin(months)).select(*new.columns)
        new = united(old.unionByName(new), ["date_key"])
    return replace_months(spark, new, target_path)


def counts_by_span(days: DataFrame, out: str) -> DataFrame:
    """``span, start_key, <out>``: distinct keys of every day, month and year.  Every
    span is united from the one below it, so a day's bitmap is read once a span."""
    def span(name: str, states: DataFrame) -> DataFrame:
        return distinct_keys(states, ["start"], out).select(
            F.lit(name).alias("span"), F.col("start").alias("start_key"), out)

    start = F.col("date_key").cast("int")
    day = days.select(start.alias("start"), BUCKET, BITS)
    month = united(day.withColumn("start", (F.col("start") / 100).cast("int") * 100 + 1), ["start"])
    year = united(month.withColumn("start", (F.col("start") / 10000).cast("int") * 10000 + 101), ["start"])
    return span("day", day).unionByName(span("month", month)).unionByName(span("year", year))
