"""Uniqueness and relationship checks that follow loads: key counts by hash slot.

The index holds every key once, with how many rows have it (one counter per kind
of row: a uniqueness check has one, a relationship counts children and parents).
It is parquet in ``slots`` folders by the key's hash.  A load counts its own keys
(a partial aggregate, so a key that most rows have is reduced before the shuffle),
reads the slots that hold one of them, adds up and replaces these slots through
the ledger.  Neither the rows of earlier loads nor other slots are read.  Keys are
kept and compared whole, the hash only deals them, so equal hashes are no hits.

What fails is a condition on the counters (more than one row; children without a
parent), which the scan checks against each row group's smallest and largest
counter.  So a report reads little of an index in which little fails.  A parent
that comes in a later load than its children heals them.

Every load has a name.  A load whose name has been applied changes nothing, and one
that breaks off after it was recorded is finished by the next.  A table has one
writer at a time.  Null keys: see the checks.  Counts only grow: a feed whose rows
are replaced needs the replaced rows' keys taken off (``sign=-1``) in a load.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ledger import Files, applied, finish, read_table, stage_months, switch

SLOT = "key_slot"
SLOTS = 16
ROWS, CHILDREN, PARENTS = "n_rows", "n_children", "n_parents"
#: Failing rows of a relationship, duplicated keys of a uniqueness check.
UNIQUE, RELATIONSHIP = "unique", "relationship"
COUNTERS = {UNIQUE: [ROWS], RELATIONSHIP: [CHILDREN, PARENTS]}


class KeyIndex:
    """Counts of keys under one folder.

    ``columns`` name the key's columns, ``kind`` is ``UNIQUE`` or ``RELATIONSHIP``.
    ``nulls``: whether a key with a null is a key like others (a grain check) or is
    left out (a column's uniqueness, a relationship).  ``slots`` is fixed by the
    first load; a few thousand suit billions of keys.
    """

    def __init__(self, spark: SparkSession, path: str, columns: list[str], kind: str = UNIQUE,
                 nulls: bool = False, slots: int = SLOTS):
        clash = {SLOT, ROWS, CHILDREN, PARENTS} & {c.lower() for c in columns}
        if clash:
            raise ValueError(f"reserved names: {sorted(clash)}")
        self.spark, self.path, self.columns = spark, path.rstrip("/"), columns
        self.kind, self.counters, self.nulls, self.slots = kind, COUNTERS[kind], nulls, slots
        files = Files(spark, self.path)
        about, meta = {"columns": columns, "kind": kind, "nulls": nulls, "slots": slots}, \
            f"{self.path}/_index.json"
        if not files.exists(meta):
            files.make(self.path)
            files.write(meta, json.dumps(about))
        elif json.loads(files.read(meta)) != about:
            raise ValueError(f"{path} is an index of another kind: {files.read(meta)}")

    def _counted(self, rows: DataFrame, columns: list[str], counter: str, sign: int) -> DataFrame:
        keys = rows.select(*[F.col(c).alias(k) for c, k in zip(columns, self.columns, strict=True)])
        if not self.nulls:
            keys = keys.dropna(subset=self.columns)
        n = F.count(F.lit(1)) * F.lit(sign)
        return keys.groupBy(*self.columns).agg(
            *[(n if c == counter else F.lit(0)).cast("long").alias(c) for c in self.counters])

    def add(self, load: str, rows: DataFrame, columns: list[str] | None = None,
            counter: str | None = None, sign: int = 1) -> list[int]:
        """Add the keys of a load's rows; returns the slots that were replaced.

        ``columns`` name the key in these rows where they have other names than the
        index's, ``counter`` what the rows are (of a relationship)."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", load):
            raise ValueError(f"not a name for a load: {load!r}")
        counter = counter or self.counters[0]
        if counter not in self.counters:
            raise ValueError(f"{counter}: not one of {self.counters}")
        if applied(self.spark, self.path, load):
            return []
        new = self._counted(rows, columns or self.columns, counter, sign).withColumn(
            SLOT, F.pmod(F.xxhash64(*self.columns), F.lit(self.slots)).cast("int"))
        batch = f"{self.path}/_batch/{load}"
        new.write.mode("overwrite").parquet(batch)  # counted once
        new = self.spark.read.schema(new.schema).parquet(batch)
        merged = new
        if any(n.startswith(SLOT) for n in Files(self.spark, self.path).names(self.path)):
            stored = self.spark.read.schema(new.schema).parquet(self.path)
            merged = self.touched(stored, new).select(*new.columns).unionByName(new).groupBy(
                SLOT, *self.columns).agg(*[F.sum(c).alias(c) for c in self.counters])
        stage_months(merged, self.path, SLOT, load)
        replaced = switch(self.spark, self.path, load, SLOT, remember=True)
        Files(self.spark, self.path).delete(batch)
        return replaced

    @staticmethod
    def touched(stored: DataFrame, new: DataFrame) -> DataFrame:
        """Stored rows of the slots that hold one of the new keys."""
        slots = [r[SLOT] for r in new.select(SLOT).distinct().collect()]  # at most all slots
        return stored.filter(F.col(SLOT).isin(slots))

    def keys(self) -> DataFrame | None:
        """Every key with its counters; None before the first row."""
        finish(self.spark, self.path)
        return read_table(self.spark, self.path)

    def failing(self) -> DataFrame | None:
        """Keys that fail, with their counters."""
        keys = self.keys()
        if keys is None:
            return None
        if self.kind == UNIQUE:
            return keys.filter(F.col(ROWS) > 1).drop(SLOT)
        return keys.filter((F.col(PARENTS) <= 0) & (F.col(CHILDREN) > 0)).drop(SLOT)

    def failures(self) -> DataFrame:
        """``failures``, one row: duplicated keys, or child rows without a parent."""
        failing = self.failing()
        if failing is None:
            return self.spark.range(1).select(F.lit(0).cast("long").alias("failures"))
        n = F.count(F.lit(1)) if self.kind == UNIQUE else F.sum(CHILDREN)
        return failing.agg(F.coalesce(n, F.lit(0)).cast("long").alias("failures"))
