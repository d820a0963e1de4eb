"""Global row numbers without a single-partition window.

``row_number() over (order by k)`` with no PARTITION BY makes Spark move every
row into one task.  Instead the rows are range-partitioned on the order key
(equal keys share a partition and partition i holds smaller keys than i+1),
sorted inside each partition by the key and the tie-break columns, and tagged
with (partition, position).  Only the order key is sampled for the range
bounds, so no wide rows reach the driver.  The
tagged rows are written as a parquet table in the shared checkpoint folder
(cheaper than an RDD checkpoint of wide rows) so a lost executor cannot
re-draw the range bounds, then a per-partition row count -- one row per
partition -- gives each partition its starting offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_path
from .dealing import partitions

_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | position
# Target stored bytes per range partition: its rows are sorted in a task's memory.
BYTES_PER_PARTITION = 32 << 20


def _partitions(df: DataFrame) -> int:
    """At least the session's shuffle partitions, more for a large input: its
    size is that of the stored tables it reads, so nothing is counted."""
    n = partitions(df, BYTES_PER_PARTITION)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), n)


def _sort_cols(df: DataFrame, order: list[str | Column], tiebreak: bool) -> list[Column]:
    cols = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    if tiebreak:
        named = {c for c in order if isinstance(c, str)}
        cols += [F.col(c).asc_nulls_last() for c in df.columns if c not in named]
    return cols


def global_row_number(
    df: DataFrame,
    order: list[str | Column],
    out_col: str = "row_number",
    num_partitions: int | None = None,
    tiebreak: bool = True,
) -> DataFrame:
    """Append ``out_col`` (long, 1-based) numbering the rows by ``order``.

    Ties in ``order`` are broken by the remaining columns (``tiebreak``), so
    the numbering is deterministic; rows of one key share a range partition, so
    a caller whose leading key is hot passes the columns that split it in
    ``order``.  NULL keys sort last.  Without ``num_partitions`` the partition
    count grows with the input (range partitions are not split later by
    adaptive execution).
    """
    spark = df.sparkSession
    sort_cols = _sort_cols(df, order, tiebreak)
    n = num_partitions or _partitions(df)
    range_cols = _sort_cols(df, order, False)
    # The tagged rows are written once (parquet in the shared folder) and
    # read back, so the offsets and the numbering see the same partitions.
    path = shared_path(spark, "row_number")
    (
        df.repartitionByRange(n, *range_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("__rid", F.monotonically_increasing_id())
        .write.mode("overwrite")
        .parquet(path)
    )
    tagged = spark.read.parquet(path)
    part = F.shiftright(F.col("__rid"), _POS_BITS)
    pos = F.col("__rid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    tagged = tagged.withColumn("__part", part).withColumn("__pos", pos)
    # One row per partition: the size is bounded by the partition count.
    offsets = (
        tagged.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn(
            "__offset",
            F.coalesce(
                F.sum("__n").over(
                    Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .select("__part", "__offset")
    )
    return (
        tagged.join(F.broadcast(offsets), "__part")
        .withColumn(out_col, (F.col("__offset") + F.col("__pos") + 1).cast("long"))
        .drop("__rid", "__part", "__pos", "__offset")
    )


def dense_keys(
    values: DataFrame, key_col: str, out_col: str, num_partitions: int | None = None
) -> DataFrame:
    """``dense_rank() over (order by key_col)`` for a column: distinct values
    numbered in order (NULL last).  Distinct values make dense rank equal to
    row number, so the same scalable numbering applies."""
    distinct = values.select(key_col).distinct()
    return global_row_number(
        distinct, [key_col], out_col=out_col, num_partitions=num_partitions, tiebreak=False
    ).select(out_col, key_col)
