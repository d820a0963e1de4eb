"""Source data-quality checks: not_null, unique, is_positive_amount.

Each check counts its failing rows (zero = pass).  All not-null and
positivity checks of a table run in one aggregation pass; a uniqueness check
is one grouped count with a partial aggregate before the shuffle.  The report
has one row per (table, column, check).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    check: str  # not_null | unique | positive


def _fail_count(c: Check) -> Column:
    x = F.col(c.column)
    if c.check == "not_null":
        return F.count_if(x.isNull())
    if c.check == "positive":
        # NULL passes the positivity check; it is the not-null check's job.
        return F.count_if(x.isNotNull() & (x <= 0))
    raise ValueError(c.check)


def failing_rows(df: DataFrame, c: Check) -> DataFrame:
    """The failing rows of one check (the rows a test query returns)."""
    x = F.col(c.column)
    if c.check == "not_null":
        return df.filter(x.isNull())
    if c.check == "positive":
        return df.filter(x.isNotNull() & (x <= 0))
    if c.check == "unique":
        return (
            df.filter(x.isNotNull())
            .groupBy(c.column)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1)
        )
    raise ValueError(c.check)


def check_table(df: DataFrame, checks: list[Check]) -> DataFrame:
    """(table_name, column_name, check_name, failures) for one table."""
    scalar = [c for c in checks if c.check != "unique"]
    parts: list[DataFrame] = []
    if scalar:
        wide = df.agg(*[_fail_count(c).alias(f"c{i}") for i, c in enumerate(scalar)])
        stack = F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c.table).alias("table_name"),
                        F.lit(c.column).alias("column_name"),
                        F.lit(c.check).alias("check_name"),
                        F.col(f"c{i}").cast("long").alias("failures"),
                    )
                    for i, c in enumerate(scalar)
                ]
            )
        )
        parts.append(wide.select(stack.alias("r")).select("r.*"))
    for c in checks:
        if c.check == "unique":
            dups = failing_rows(df, c).agg(F.count(F.lit(1)).cast("long").alias("failures"))
            parts.append(
                dups.select(
                    F.lit(c.table).alias("table_name"),
                    F.lit(c.column).alias("column_name"),
                    F.lit(c.check).alias("check_name"),
                    "failures",
                )
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# The declared source tests (table, column, test).
SOURCE_CHECKS = [
    Check("raw_news", "id", "not_null"),
    Check("raw_news", "id", "unique"),
    Check("raw_news", "headline", "not_null"),
    Check("raw_news", "datetime", "not_null"),
    Check("raw_news", "related", "not_null"),
    Check("raw_stocks", "symbol", "not_null"),
    Check("raw_stocks", "datetime", "not_null"),
    Check("raw_stocks", "open", "not_null"),
    Check("raw_stocks", "open", "positive"),
    Check("raw_stocks", "high", "not_null"),
    Check("raw_stocks", "high", "positive"),
    Check("raw_stocks", "low", "not_null"),
    Check("raw_stocks", "low", "positive"),
    Check("raw_stocks", "close", "not_null"),
    Check("raw_stocks", "close", "positive"),
    Check("raw_stocks", "volume", "not_null"),
    Check("raw_stocks", "volume", "positive"),
    Check("raw_weather", "raw_date", "not_null"),
    Check("raw_weather", "city", "not_null"),
]


def quality_report(tables: dict[str, DataFrame], checks: list[Check] = SOURCE_CHECKS) -> DataFrame:
    parts = []
    for name, df in tables.items():
        mine = [c for c in checks if c.table == name]
        if mine:
            parts.append(check_table(df, mine))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def relationship_failures(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (a relationships test)."""
    keys = parent.select(F.col(parent_col).alias("__k"))
    return child.filter(F.col(child_col).isNotNull()).join(
        keys, F.col(child_col) == F.col("__k"), "left_anti"
    )


def relationship_report(links: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(table_name, column_name, check_name, failures) for foreign-key links.

    ``links`` holds (child name, child frame, child column, parent frame,
    parent column); each link is one anti join against the parent's keys.
    """
    parts = [
        relationship_failures(child, col, parent, pcol)
        .agg(F.count(F.lit(1)).cast("long").alias("failures"))
        .select(
            F.lit(name).alias("table_name"),
            F.lit(col).alias("column_name"),
            F.lit("relationships").alias("check_name"),
            "failures",
        )
        for name, child, col, parent, pcol in links
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once (NULL counts as a value):
    the failing rows of a composite uniqueness (grain) check."""
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def grain_report(grains: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """(table_name, column_name, check_name, failures) for composite keys that
    should identify one row each; one grouped count per table."""
    parts = [
        duplicate_keys(df, cols)
        .agg(F.count(F.lit(1)).cast("long").alias("failures"))
        .select(
            F.lit(name).alias("table_name"),
            F.lit(",".join(cols)).alias("column_name"),
            F.lit("unique_combination").alias("check_name"),
            "failures",
        )
        for name, df, cols in grains
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
