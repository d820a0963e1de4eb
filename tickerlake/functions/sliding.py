"""Sliding ROWS frames whose cost doesn't grow with the frame's length.

A window function over ``rows between n preceding and current row`` looks at
every row of the frame again for every row.  Here a frame is put together from
stretches of 1, 2, 4, 8, ... rows that end at a row: the stretch of twice the
length is the row's own and the one that far back, which is a ``lag``.  A frame
of n rows is a handful of such stretches side by side (extremes: two that
overlap), so it takes as many lags as n has binary digits, all over one
partitioning and order: one shuffle and one sort, whatever the frames.

Stretches are merged, never taken apart: sums don't lose digits to a subtraction,
and mean and squared deviations merge pairwise.  Which rows make up a stretch
depends on the row alone, so a series cut into chunks gives the same bits.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalar import safe_div
from .windows import ordered

State = list[Column]


def _present(*cols: str) -> Column:
    here = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        here = here & F.col(c).isNotNull()
    return here


def _value(here: Column, col: str) -> Column:
    return F.when(here, F.col(col).cast("double")).otherwise(F.lit(0.0))


def _one(here: Column) -> Column:
    return F.when(here, F.lit(1.0)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Kind:
    """A mergeable aggregate: ``lift`` a row, ``merge`` an older with a newer stretch.
    ``empty`` is what a stretch before the series has, per column of the state."""

    lift: Callable[..., State]
    merge: Callable[[State, State], State]
    empty: tuple[float | None, ...]
    overlaps: bool = False


def _lift_sum(v: str) -> State:
    here = _present(v)
    return [_one(here), _value(here, v)]


def _lift_moments(v: str) -> State:
    here = _present(v)
    return [_one(here), _value(here, v), F.lit(0.0)]


def _lift_pair(x: str, y: str) -> State:
    here = _present(x, y)
    return [_one(here), _value(here, x), _value(here, y), F.lit(0.0), F.lit(0.0), F.lit(0.0)]


def _lift_covar(x: str, y: str) -> State:
    here = _present(x, y)
    return [_one(here), _value(here, x), _value(here, y), F.lit(0.0)]


def _shares(a: State, b: State) -> tuple[Column, Column, Column]:
    """Rows of both, the newer one's share of them, and n_a * n_b / n."""
    n = a[0] + b[0]
    some = F.greatest(n, F.lit(1.0))
    return n, b[0] / some, a[0] * b[0] / some


def _merge_moments(a: State, b: State) -> State:
    n, share, both = _shares(a, b)
    d = b[1] - a[1]
    return [n, a[1] + d * share, a[2] + b[2] + d * d * both]


def _merge_covar(a: State, b: State) -> State:
    n, share, both = _shares(a, b)
    dx, dy = b[1] - a[1], b[2] - a[2]
    return [n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dy * both]


def _merge_pair(a: State, b: State) -> State:
    n, share, both = _shares(a, b)
    dx, dy = b[1] - a[1], b[2] - a[2]
    return [n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * both,
            a[4] + b[4] + dy * dy * both, a[5] + b[5] + dx * dy * both]


KINDS = {
    "sum": Kind(_lift_sum, lambda a, b: [a[0] + b[0], a[1] + b[1]], (0.0, 0.0)),
    "max": Kind(lambda v: [F.col(v)], lambda a, b: [F.greatest(a[0], b[0])], (None,), True),
    "min": Kind(lambda v: [F.col(v)], lambda a, b: [F.least(a[0], b[0])], (None,), True),
    "moments": Kind(_lift_moments, _merge_moments, (0.0,) * 3),
    "covar": Kind(_lift_covar, _merge_covar, (0.0,) * 4),
    "pair": Kind(_lift_pair, _merge_pair, (0.0,) * 6),
}


@dataclass(frozen=True)
class Frame:
    """An aggregate over ``rows`` rows that end ``behind`` rows before the current
    one; ``outs`` are columns made of its state."""

    kind: str
    values: tuple[str, ...]
    rows: int
    outs: dict[str, Callable[[State], Column]]
    behind: int = 0

    @property
    def measure(self) -> tuple[str, tuple[str, ...]]:
        return self.kind, self.values

    def pieces(self) -> list[tuple[int, int]]:
        """``(length, rows back)`` of the stretches of the frame, newest first."""
        if KINDS[self.kind].overlaps:
            top = 1 << (self.rows.bit_length() - 1)
            more = [(top, self.behind + self.rows - top)] if top < self.rows else []
            return [(top, self.behind), *more]
        out, back = [], self.behind
        for bit in range(self.rows.bit_length() - 1, -1, -1):
            if self.rows >> bit & 1:
                out.append((1 << bit, back))
                back += 1 << bit
        return out


def avg(s: State) -> Column:
    """Of the frame's values; null without any."""
    return safe_div(s[1], s[0])


def mean(s: State) -> Column:
    """The mean in ``moments``; null without any value."""
    return F.when(s[0] > 0, s[1])


def stddev(s: State) -> Column:
    return F.when(s[0] > 1, F.sqrt(s[2] / (s[0] - 1)))


def covar(s: State) -> Column:
    return F.when(s[0] > 1, s[3] / (s[0] - 1))


def corr(s: State) -> Column:
    """Null where a side doesn't vary."""
    return F.when(s[0] > 1, safe_div(
        s[5] / (s[0] - 1), F.sqrt(s[3] / (s[0] - 1)) * F.sqrt(s[4] / (s[0] - 1))))


def extreme(s: State) -> Column:
    return s[0]


def sliding(df: DataFrame, part: list[str], order: list[str], frames: list[Frame]) -> DataFrame:
    """``df`` with the columns of all frames over its series."""
    own = df.columns
    window = ordered(part, order)
    measures = list(dict.fromkeys(f.measure for f in frames))
    longest = {m: max(p for f in frames if f.measure == m for p, _ in f.pieces()) for m in measures}
    used = {(f.measure, p) for f in frames for p, _ in f.pieces()}

    def names(m, length: int) -> list[str]:
        return [f"__sliding_{measures.index(m)}_{length}_{j}" for j in range(len(KINDS[m[0]].empty))]

    def back(m, length: int, rows: int) -> State:
        """The stretch that ends so many rows before."""
        if not rows:
            return [F.col(c) for c in names(m, length)]
        return [F.lag(c, rows, e).over(window)
                for c, e in zip(names(m, length), KINDS[m[0]].empty)]

    lifted = [c.alias(n) for m in measures for c, n in zip(KINDS[m[0]].lift(*m[1]), names(m, 1))]
    now = df.select("*", *lifted)
    held = [(m, 1) for m in measures]
    length = 1
    while any(longest[m] > length for m in measures):
        new = [m for m in measures if longest[m] > length]
        # a lag is a column of its own first: what merges them stays in code generation
        lags = {m: [f"{n}_lag" for n in names(m, length)] for m in new}
        now = now.select("*", *[
            c.alias(n) for m in new for c, n in zip(back(m, length, length), lags[m])])
        keep = [(m, p) for m, p in held if (m, p) in used]
        now = now.select(
            *own, *[n for m, p in keep for n in names(m, p)],
            *[c.alias(n) for m in new for c, n in zip(
                KINDS[m[0]].merge([F.col(c) for c in lags[m]], [F.col(c) for c in names(m, length)]),
                names(m, 2 * length))])
        held = keep + [(m, 2 * length) for m in new]
        length *= 2
    placed: dict[tuple, list[str]] = {}
    lagged = []
    for f in frames:
        for p, rows in f.pieces():
            key = (f.measure, p, rows)
            if key not in placed:
                placed[key] = names(f.measure, p) if not rows else [
                    f"{n}_at{rows}" for n in names(f.measure, p)]
                if rows:
                    lagged += [c.alias(n) for c, n in zip(back(f.measure, p, rows), placed[key])]
    now = now.select("*", *lagged)
    outs = []
    for f in frames:
        newest, *older = [[F.col(c) for c in placed[f.measure, p, rows]] for p, rows in f.pieces()]
        for state in older:
            newest = KINDS[f.kind].merge(state, newest)
        outs += [make(newest).alias(name) for name, make in f.outs.items()]
    return now.select(*own, *outs)
