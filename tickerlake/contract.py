"""Output contract for cross-engine checks.

Each registered query declares its output columns and types.  The contract
layer casts to those types and passes doubles through a fixed 5-decimal
rounding, ``floor(x * 1e5 + 0.5001) / 1e5``, on both the Spark side and the
SQL oracle, so last-bit differences between engines (summation order) do not
decide a comparison.  The library functions themselves return unrounded values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPARK_TYPES = {
    "i": "int",
    "l": "bigint",
    "d": "double",
    "s": "string",
    "b": "boolean",
    "t": "date",
    "a": "array<string>",
}
SQL_TYPES = {
    "i": "INTEGER",
    "l": "BIGINT",
    "d": "DOUBLE",
    "s": "VARCHAR",
    "b": "BOOLEAN",
    "t": "DATE",
    "a": "VARCHAR[]",
}


def parse_spec(spec: str) -> list[tuple[str, str]]:
    """``"date_key:i symbol:s"`` -> ``[("date_key", "i"), ("symbol", "s")]``."""
    out = []
    for item in spec.split():
        name, code = item.rsplit(":", 1)
        out.append((name, code))
    return out


# From here on a double has no digits behind the fifth decimal to speak of, and
# the scaled value would leave the integers.
LARGE = 1e12


def contract_round(c: Column) -> Column:
    """NaN, infinities and values of ``LARGE`` or more pass as they are."""
    plain = F.isnan(c) | (F.abs(c) >= F.lit(LARGE))
    return F.when(plain, c).otherwise(F.floor(c * F.lit(1e5) + F.lit(0.5001)) / F.lit(1e5))


def apply_spark(df: DataFrame, spec: str) -> DataFrame:
    cols = []
    for name, code in parse_spec(spec):
        c = F.col(name).cast(SPARK_TYPES[code])
        if code == "d":
            c = contract_round(c)
        cols.append(c.alias(name))
    return df.select(*cols)


def apply_sql(sql: str, spec: str) -> str:
    cols = []
    for name, code in parse_spec(spec):
        c = f'CAST("{name}" AS {SQL_TYPES[code]})'
        if code == "d":
            c = (f"CASE WHEN isnan({c}) OR abs({c}) >= {LARGE:.0f} THEN {c} "
                 f"ELSE floor({c} * 1e5 + CAST(0.5001 AS DOUBLE)) / 1e5 END")
        cols.append(f'{c} AS "{name}"')
    return f"SELECT {', '.join(cols)}\nFROM (\n{sql}\n) AS q"
