"""Rows dealt by key into partitions that a task sorts in memory.

Spark deals a shuffle into the session's number of partitions at every size, so
sorts after it spill once the input has outgrown that number.  ``dealt`` takes
more partitions where the stored tables behind the rows are larger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Stored (compressed) bytes a task is dealt: a few hundred MB of rows once read.
BYTES_PER_TASK = 32 << 20
# The same where a task holds a series' rows with all their features, and joins them.
BYTES_PER_SLOT = 16 << 20
# Column that numbers the partition of a row dealt by ``dealt_to``.
SLOT = "__slot"
# Rows (a few numbers each) up to which a table is sent to every task.
MOST_SENT = 500_000


def partitions(df: DataFrame, bytes_per_task: int) -> int:
    """Partitions that a frame's input needs: its size is that of the stored
    tables it reads, so nothing is counted."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())]
    known = sum(s for s in sizes if s < 1 << 62)  # frames without a size have the largest
    return -(-known // bytes_per_task)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with rows of equal keys in one partition."""
    n = partitions(df, BYTES_PER_TASK)
    if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(n, *keys)
    return df.repartition(*keys)  # adaptive execution may join small partitions


def slots(df: DataFrame) -> int:
    """Partitions for ``dealt_to``: the session's at least, more for larger tables."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
               partitions(df, BYTES_PER_SLOT))


def dealt_to(df: DataFrame, key: str, n: int) -> DataFrame:
    """``df`` with rows of equal keys in one of ``n`` partitions, numbered in ``SLOT``.

    Spark shuffles rows dealt by one key again to join them by that key and others.
    Frames dealt alike to as many slots are joined where they are, by ``SLOT`` and any
    other columns, also after windows over ``SLOT`` and the key."""
    # never null, so a join has no nulls to leave out before the shuffle
    slot = F.coalesce(F.pmod(F.hash(key), F.lit(n)), F.lit(0))
    return df.withColumn(SLOT, slot).repartitionById(n, SLOT)


def sent_if_small(df: DataFrame) -> DataFrame:
    """The small side of a join (counted, so stored or quickly made): sent to every task
    up to ``MOST_SENT`` rows, so the large side isn't shuffled by its key; a larger one
    is joined as the planner sees fit."""
    few = df.limit(MOST_SENT + 1).count() <= MOST_SENT
    return F.broadcast(df) if few else df
