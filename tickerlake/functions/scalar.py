"""Row-level expressions shared by the models (all JVM-side Column code)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c: str | Column) -> Column:
    """Integer YYYYMMDD key of a date or timestamp (``to_number(to_char(d, 'YYYYMMDD'))``)."""
    d = F.to_date(col_(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def with_month(df: DataFrame, day: str) -> DataFrame:
    """``month_key`` (YYYYMM) of an integer day key or a date column."""
    c = F.col(day)
    if dict(df.dtypes)[day] == "date":
        c = F.year(c) * 10000 + F.month(c) * 100
    return df.withColumn("month_key", F.floor(c / 100).cast("int"))


def key_to_date(c: str | Column) -> Column:
    """Inverse of :func:`date_key`."""
    return F.to_date(col_(c).cast("string"), "yyyyMMdd")


def safe_div(num: str | Column, den: str | Column) -> Column:
    """``num / nullif(den, 0)``: NULL instead of an error on a zero divisor."""
    return F.try_divide(col_(num), col_(den))


def pct(num: str | Column, den: str | Column) -> Column:
    """``num / nullif(den, 0) * 100``."""
    return safe_div(num, den) * F.lit(100.0)


def round_half_up(c: str | Column, scale: int) -> Column:
    """Rounding of a double's decimal digits, half away from zero."""
    return F.round(col_(c), scale)


def exact_avg(c: str | Column) -> Column:
    """Mean of doubles that hold decimals (prices, rounded percentages): summed
    as decimals, so the order of the rows leaves no trace in the last bits, which
    would decide how a tie is rounded."""
    v = col_(c)
    return safe_div(F.sum(v.cast("decimal(28,8)")).cast("double"), F.count(v))


def weather_key(city: str | Column, dkey: str | Column) -> Column:
    """``sha2(city || '-' || date_key, 256)``; NULL when any part is NULL."""
    return F.sha2(F.concat(col_(city), F.lit("-"), col_(dkey).cast("string")), 256)


def direction(open_: str | Column, close: str | Column) -> Column:
    """UP / DOWN / FLAT by close versus open."""
    o, c = col_(open_), col_(close)
    return F.when(c > o, "UP").when(c < o, "DOWN").otherwise("FLAT")


def weather_type(precip: str | Column) -> Column:
    # Precipitation buckets of the weather report.
    p = col_(precip)
    return (
        F.when(p > 5, "Rainy (>5mm)")
        .when(p > 0, "Light Rain (0-5mm)")
        .otherwise("Dry")
    )


def flag_points(cond: Column, points: int) -> Column:
    """``case when cond then points else 0 end`` (NULL condition gives 0)."""
    return F.when(cond, F.lit(points)).otherwise(F.lit(0))
