"""Window specs and rolling statistics over (series key, date_key).

Every per-symbol statistic is a ROWS frame over one partition key ordered by
``date_key`` and, where a day repeats, by the row's remaining columns.  Specs built here share partition and order, so Spark plans all
of them after a single hash exchange + sort.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from .scalar import col_, safe_div


def ordered(part: str | list[str], order: str | list[str] = "date_key") -> WindowSpec:
    parts = [part] if isinstance(part, str) else list(part)
    by = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*parts).orderBy(*[F.col(c).asc_nulls_last() for c in by])


def trailing(
    part: str | list[str], n_preceding: int, order: str | list[str] = "date_key"
) -> WindowSpec:
    """``rows between n preceding and current row``."""
    return ordered(part, order).rowsBetween(-n_preceding, Window.currentRow)


def running(part: str | list[str], order: str | list[str] = "date_key") -> WindowSpec:
    """``rows between unbounded preceding and current row``."""
    return ordered(part, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def full_rolling(agg: Column, value: str | Column, w: WindowSpec, size: int) -> Column:
    """Rolling statistic reported only once the frame holds ``size`` non-NULL values."""
    return F.when(F.count(col_(value)).over(w) >= size, agg.over(w))


def rolling_corr(x: str | Column, y: str | Column, w: WindowSpec) -> Column:
    """Sample correlation over a window, NULL when either side has zero variance.

    ``corr`` itself raises on zero variance under ANSI arithmetic, so the
    statistic is composed from covariance and standard deviations taken over
    the rows where both values are present.
    """
    xc, yc = col_(x), col_(y)
    both = xc.isNotNull() & yc.isNotNull()
    sx = F.stddev_samp(F.when(both, xc)).over(w)
    sy = F.stddev_samp(F.when(both, yc)).over(w)
    return safe_div(F.covar_samp(xc, yc).over(w), sx * sy)
