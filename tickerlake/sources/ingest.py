"""Feeds as they come: records whose columns drift and whose values don't parse.

A feed's files are read as text and every record becomes a map of column name to
text, so that files with missing, additional, renamed or reordered columns are read
alike and none of them fails a job.  Values are then cast by a declared
schema (``FeedSpec``).  A record is accepted, or quarantined with every reason
that holds against it:

* ``unreadable``: no JSON object, or more CSV fields than the header names;
* ``missing <column>``: a required column is absent, null or blank;
* ``bad <column>``: a text that isn't a value of the column's type (a number that
  is not finite included);
* ``rule <name>``: a rule over the cast columns is false (null passes).

A load writes both kinds in one pass, under its own id, so a load that is
repeated replaces what it had written and counts add up: records = accepted +
quarantined.  Quarantined records keep their text.  Rows are never collected;
only the widest CSV header is a number on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path
from .raw import LOAD_SEQ, STOCK_SCHEMA, WEATHER_FEED_SCHEMA

#: Spellings of days and times that are tried in turn.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "dd.MM.yyyy", "yyyy-MM-dd HH:mm:ss")
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss[.SSSSSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]", "yyyy-MM-dd")

FIELDS = T.MapType(T.StringType(), T.StringType())
#: When a file was written, its name, the split it was read from, the line's place there.
SEQ_TYPE = T.StructType([
    T.StructField("written", T.TimestampType()), T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()), T.StructField("place", T.LongType()),
])


@dataclass(frozen=True)
class FeedSpec:
    """What a feed's records must look like.

    ``aliases``: other names a column has had; of several present the declared
    one counts, then the aliases in order.  ``required``: columns that must have a
    value.  ``formats``: spellings of a date or time column, instead of the usual
    ones.  ``rules``: name to an SQL condition over the cast columns.
    """

    schema: T.StructType
    aliases: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    formats: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    rules: Mapping[str, str] = field(default_factory=dict)

    def names(self, column: str) -> tuple[str, ...]:
        return (column, *self.aliases.get(column, ()))

    def known(self) -> dict[str, str]:
        """Every name of a declared column and that column."""
        return {n: c for c in reversed(self.schema.names) for n in self.names(c)}

    def stored(self) -> T.StructType:
        """Columns of a load as it is written."""
        return T.StructType([
            *[T.StructField(f.name, f.dataType) for f in self.schema.fields],
            T.StructField("extra_columns", FIELDS), T.StructField(LOAD_SEQ, SEQ_TYPE),
            T.StructField("reasons", T.ArrayType(T.StringType())),
            T.StructField("record", T.StringType()),
        ])


STOCKS = FeedSpec(
    STOCK_SCHEMA,
    aliases={"symbol": ("ticker",), "volume": ("vol",), "datetime": ("date", "day")},
    required=("symbol", "datetime", "close"),
    rules={"volume": "volume >= 0", "price": "least(open, high, low, close) > 0", "range": "high >= low"},
)
WEATHER = FeedSpec(
    WEATHER_FEED_SCHEMA, aliases={"date": ("raw_date", "day")}, required=("date", "city"),
    rules={"range": "max_temp >= min_temp"},
)


# -- records ------------------------------------------------------------
def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``record`` (a line that isn't blank), its sequence."""
    return spark.read.text(path).select(
        F.col("value").alias("record"),
        F.struct(
            F.col("_metadata.file_modification_time").alias("written"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
        ).alias(LOAD_SEQ),
    ).filter(F.trim("record") != "")


def _json(spark: SparkSession, path: str) -> DataFrame:
    return _lines(spark, path).withColumn("fields", F.from_json("record", FIELDS))


def _csv(spark: SparkSession, path: str) -> DataFrame:
    """Every file by its own header, its first line.  A line that equals the header
    is no record; a record is one line."""
    lines = _lines(spark, path)
    place = F.col(f"{LOAD_SEQ}.place")
    # one row per file, staged so that the join below knows its size
    head_path = shared_path(spark, "csv_headers")
    lines.filter(F.col(f"{LOAD_SEQ}.block") == 0).groupBy(
        F.col(f"{LOAD_SEQ}.file").alias("of_file")
    ).agg(F.regexp_replace(F.min_by("record", place), "^\ufeff", "").alias("header")).write.parquet(head_path)
    heads = spark.read.schema("of_file string, header string").parquet(head_path)
    commas = F.length("header") - F.length(F.replace("header", F.lit(",")))
    width = (heads.agg(F.max(commas)).first()[0] or 0) + 1
    cells = ", ".join(f"c{i} string" for i in range(width + 1))  # one more tells ragged lines

    def split(col: str) -> Column:
        parsed = F.from_csv(col, cells)
        return F.array(*[parsed[f"c{i}"] for i in range(width + 1)])

    rows = lines.join(heads, F.col(f"{LOAD_SEQ}.file") == F.col("of_file")).filter(
        F.regexp_replace("record", "^\ufeff", "") != F.col("header"))
    rows = rows.withColumns({
        "names": F.transform(split("header"), lambda n: F.trim(n)), "cells": split("record"),
    })
    pairs = F.filter(
        F.transform("names", lambda n, i: F.struct(
            n.alias("name"), F.col("cells")[i].alias("value"),
            (F.array_position("names", n) == i + 1).alias("first"))),
        lambda p: p["name"].isNotNull() & p["value"].isNotNull() & p["first"],
    )
    ragged = F.exists(
        F.arrays_zip("names", "cells"), lambda p: p["names"].isNull() & p["cells"].isNotNull())
    fields = F.map_from_entries(
        F.transform(pairs, lambda p: F.struct(p["name"], p["value"])))
    return rows.select("record", LOAD_SEQ, F.when(~ragged, fields).alias("fields"))


def records(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """A feed's records: ``record`` (its text), ``fields`` (name to text, null where
    the record can't be read), ``load_seq``.  ``fmt`` is ``json`` (one object a
    line) or ``csv`` (a header in every file)."""
    if fmt not in ("json", "csv"):
        raise ValueError(f"text feeds are json or csv, not {fmt}")
    return (_json if fmt == "json" else _csv)(spark, path)


# -- casting ------------------------------------------------------------
def _cast(raw: Column, dtype: T.DataType, formats: tuple[str, ...] | None) -> Column:
    """The value that a text spells, null where it spells none."""
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, (T.DateType, T.TimestampType)):
        usual = DATE_FORMATS if isinstance(dtype, T.DateType) else TIME_FORMATS
        tries = [F.try_to_timestamp(raw, F.lit(f)).cast(dtype) for f in formats or usual]
        return F.coalesce(*tries)
    value = raw.try_cast(dtype)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        finite = ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
        return F.when(finite, value)
    return value


def classify(rows: DataFrame, spec: FeedSpec) -> DataFrame:
    """Records with their cast columns, the columns no one declared
    (``extra_columns``, null without any) and the ``reasons`` against them."""
    def raw(c: str) -> Column:
        texts = [F.trim(F.col("fields")[n]) for n in spec.names(c)]
        return F.coalesce(*[F.when(t != "", t) for t in texts])

    texts = rows.select("record", LOAD_SEQ, "fields", F.struct(
        *[raw(c).alias(c) for c in spec.schema.names]).alias("texts"))
    cast = texts.select(
        "record", LOAD_SEQ, "fields", "texts",
        *[_cast(F.col(f"texts.{f.name}"), f.dataType, spec.formats.get(f.name)).alias(f.name)
          for f in spec.schema.fields],
    )
    against = [F.when(F.col(f"texts.{c}").isNull(), F.lit(f"missing {c}")) for c in spec.required]
    against += [F.when(F.col(f"texts.{c}").isNotNull() & F.col(c).isNull(), F.lit(f"bad {c}"))
                for c in spec.schema.names]
    against += [F.when(~F.expr(rule), F.lit(f"rule {name}")) for name, rule in spec.rules.items()]
    extra = F.map_filter("fields", lambda name, _: ~name.isin(list(spec.known())))
    return cast.select(
        *spec.schema.names,
        F.when(F.size(extra) > 0, extra).alias("extra_columns"), LOAD_SEQ,
        F.when(F.col("fields").isNull(), F.array(F.lit("unreadable")))
        .otherwise(F.array_compact(F.array(*against))).alias("reasons"),
        "record",
    )


def column_report(rows: DataFrame, spec: FeedSpec) -> DataFrame:
    """``name, meaning, records``: every column name the records carry, what it is
    (the declared column it stands for, null for an unknown one) and how many
    records carry it; declared columns that none carries have 0."""
    known = spec.known()
    names = rows.select(F.explode(F.map_keys("fields")).alias("name"), F.lit(1).alias("n"))
    declared = rows.sparkSession.createDataFrame([(c, 0) for c in spec.schema.names], "name string, n int")
    meaning = F.coalesce(*[F.when(F.col("name") == n, F.lit(c)) for n, c in known.items()])
    return names.unionByName(declared).groupBy("name").agg(
        F.sum("n").alias("records")).select("name", meaning.alias("meaning"), "records")


# -- loads --------------------------------------------------------------
def load(spark: SparkSession, path: str, spec: FeedSpec, root: str, load_id: str,
         fmt: str = "json") -> None:
    """Load a feed's files into the store at ``root``.  Accepted and quarantined
    records are written in one pass; a load of the same id replaces its rows."""
    rows = classify(records(spark, path, fmt), spec).withColumn("ok", F.size("reasons") == 0)
    kept = F.when(~F.col("ok"), F.col("record"))
    rows.withColumn("record", kept).write.mode("overwrite").partitionBy("ok").parquet(
        f"{root.rstrip('/')}/load_id={load_id}")


def _stored(spark: SparkSession, spec: FeedSpec, root: str) -> DataFrame:
    schema = T.StructType([*spec.stored().fields, T.StructField("load_id", T.StringType()),
                           T.StructField("ok", T.BooleanType())])
    try:
        return spark.read.schema(schema).parquet(root)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def accepted(spark: SparkSession, spec: FeedSpec, root: str) -> DataFrame:
    """Accepted records: the declared columns, ``extra_columns`` and ``load_seq``,
    which tells the later of two records of a key (``operators.upsert``)."""
    return _stored(spark, spec, root).filter("ok").select(
        *spec.schema.names, "extra_columns", LOAD_SEQ)


def quarantined(spark: SparkSession, spec: FeedSpec, root: str) -> DataFrame:
    """Quarantined records: what could be cast of them, reasons, text, file, load."""
    return _stored(spark, spec, root).filter("not ok").select(
        *spec.schema.names, "extra_columns", "reasons", "record", F.col(f"{LOAD_SEQ}.file").alias("file"), "load_id")


def reason_counts(spark: SparkSession, spec: FeedSpec, root: str) -> DataFrame:
    """``load_id, reason, records``: accepted records have the reason ``accepted``;
    a record with several reasons counts under each."""
    reason = F.when(F.col("ok"), F.array(F.lit("accepted"))).otherwise(F.col("reasons"))
    return _stored(spark, spec, root).select("load_id", F.explode(reason).alias("reason")).groupBy(
        "load_id", "reason").agg(F.count(F.lit(1)).alias("records"))
