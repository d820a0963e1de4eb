"""Month folders of a stored table, switched through a write-ahead ledger.

A load writes the new content of every month it touches once, into a folder
beside the table's months that readers skip (``_staging``).  Then it records the
load and its months in the table's ledger, moves each month to its place, and
takes the record out.  A load that breaks off before the record has changed
nothing; one that breaks off after it is finished by whoever touches the table
next (``finish``): a month still in the staging folder is moved, one that is not
there any more has been.  A table has one writer at a time.

Moves are renames inside one folder of the table's file system, so no row is
written twice.

Tables that are not kept by month name their folders' column (``part``).  A load
that must not be applied twice is given a name of its own and remembered: its
record is kept aside when it is finished (``applied``).
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PART_COL = "month_key"
STAGING = "_staging"
LEDGER = "_ledger"
APPLIED = "_applied"


class Files:
    """The file system that a path is in, through Hadoop's interface."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._fs = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self.path(path))

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none where it doesn't exist."""
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(folder)))

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self.path(source), self.path(target)):
            raise OSError(f"{source} could not be moved to {target}")

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self.path(folder))

    def delete(self, path: str) -> None:
        self._fs.delete(self.path(path), True)

    def read(self, path: str) -> str:
        stream = self._fs.open(self.path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """All of the text or nothing: written aside, then moved."""
        aside = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self._fs.create(self.path(aside))
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(aside, path)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, None where it has no files yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def stage_months(df: DataFrame, target: str, part: str = PART_COL, load: str | None = None,
                 deal: bool = True) -> str:
    """Write rows with a ``date_key`` (or a ``month_key`` of their own) beside the
    table, in a folder per month; returns the load's id.

    Rows are dealt by month at run-time sizes: a large month is split, small
    months share a task, and no sampling job runs before.  Without ``deal`` every
    task writes its own rows into their months: no shuffle, but up to a file per
    task and month."""
    load = load or uuid.uuid4().hex
    if part not in df.columns:
        df = df.withColumn(part, (F.col("date_key") / 100).cast("int"))
    (df.hint("rebalance", part) if deal else df).write.mode("overwrite").partitionBy(part).parquet(
        f"{target}/{STAGING}/{load}")
    return load


def switch(spark: SparkSession, target: str, load: str, part: str = PART_COL,
           remember: bool = False) -> list[int]:
    """Record a staged load and put its months in place; returns the months."""
    files = Files(spark, target)
    prefix = f"{part}="
    months = [n for n in files.names(f"{target}/{STAGING}/{load}") if n.startswith(prefix)]
    if months or remember:
        files.write(f"{target}/{LEDGER}/{load}.json",
                    json.dumps({"load": load, "months": months, "remember": remember}))
    finish(spark, target)
    files.delete(f"{target}/{STAGING}/{load}")
    return [int(m.removeprefix(prefix)) for m in months]


def finish(spark: SparkSession, target: str) -> int:
    """Finish every recorded load; returns how many there were."""
    files = Files(spark, target)
    records = []
    for name in files.names(f"{target}/{LEDGER}"):
        if name.endswith(".json"):
            records.append(name)
        else:  # a record that was never put in place
            files.delete(f"{target}/{LEDGER}/{name}")
    for name in records:
        record = json.loads(files.read(f"{target}/{LEDGER}/{name}"))
        staged = f"{target}/{STAGING}/{record['load']}"
        for month in record["months"]:
            if files.exists(f"{staged}/{month}"):
                files.delete(f"{target}/{month}")
                files.move(f"{staged}/{month}", f"{target}/{month}")
        if record.get("remember"):
            files.make(f"{target}/{APPLIED}")
            files.move(f"{target}/{LEDGER}/{name}", f"{target}/{APPLIED}/{name}")
        else:
            files.delete(f"{target}/{LEDGER}/{name}")
        files.delete(staged)
    return len(records)


def applied(spark: SparkSession, target: str, load: str) -> bool:
    """Whether a remembered load has been applied (an open one is finished first)."""
    finish(spark, target)
    return Files(spark, target).exists(f"{target}/{APPLIED}/{load}.json")


def replace_months(spark: SparkSession, df: DataFrame, target: str) -> list[int]:
    """Put rows in place of all rows of the months they are in."""
    finish(spark, target)
    return switch(spark, target, stage_months(df, target))
