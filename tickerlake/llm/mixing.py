"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source wants ``target / source size`` copies.  The integral
part is taken as it is; the fractional parts are rounded dependently, so the
words a source gives stay at its target instead of scattering around it:

* Two documents with fractional copies exchange mass (words) until one of them
  has an integral number.  Which way the mass moves is drawn with the
  probabilities that leave each document's expected copies unchanged; the sum
  of words never changes.  The one that stays fractional meets the next.
* The exchange runs in leaves of a fixed number of rows each, largest documents
  first so that what stays fractional is small, holding one at a time.  Each leaf hands at most one
  document per source to the next level of a reduction tree, until one is left
  per source, which is rounded at random.  A source ends within one document
  of its target.

The draws are hashes of a seed and the two ids, and leaves depend on the rows
alone, so reruns, lost executors and other cluster sizes give the same mix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.row_number import global_row_number
from .common import batches, n_words, shuffle_partitions, stage, values

#: Weights by rank of the source, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Size of the mix against all input, and most copies of a source.
SHARE, CEILING = 1.5, 2.0
ROWS_PER_LEAF = 50_000
FAN_IN = 32
SEED = 42
_EPS = 1e-12


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
    ceiling: float = CEILING,
) -> DataFrame:
    """``source, source_size, weight, target`` from ``source, size`` rows.

    Sources take the weights in order of their code points, null last,
    repeating.  A target is its weight's share of ``share`` times all sizes, at
    most ``ceiling`` times its source; what is cut off goes to the others by
    weight until none is above.  That is ``min(ceiling * size, level * weight)``
    for one level, which rises from round to round until no more sources reach
    their ceiling; each round is an aggregate of two numbers.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_row_number(per_source, ["source"], out_col="rank", tiebreak=False)
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    table = stage(
        ranked.select("source", "source_size", weight.alias("weight"),
                      (F.col("source_size") * F.lit(float(ceiling))).alias("most")),
        "mix_sources",
    )
    all_words, all_weights = table.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = share * (all_words or 0)
    level = wanted / all_weights if all_weights else 0.0
    capped = -1
    while True:
        full = F.col("most") <= F.lit(level) * F.col("weight")
        n, taken, rest = table.agg(
            F.count_if(full), F.sum(F.when(full, F.col("most"))),
            F.sum(F.when(~full, F.col("weight"))),
        ).first()
        if n == capped or not rest:
            break
        capped, level = n, (wanted - (taken or 0.0)) / rest
    return table.select(
        "source", "source_size", "weight",
        F.least(F.col("most"), F.lit(float(level)) * F.col("weight")).alias("target"),
    )


def _uniform(seed: int, *ids) -> float:
    return (xxhash.xxh64_intdigest(repr(ids), seed=seed) >> 11) / (1 << 53)


def exchange(held: tuple, came: tuple, draw: float) -> tuple[list[tuple], tuple | None]:
    """One step for two fractional items ``(row, size, x)``, ``0 < x < 1``.

    Gives the ``(row, 0 or 1)`` that became integral and the item still
    fractional, or None.  ``size * x`` summed over both stays the same; over
    a uniform ``draw`` each ``x`` keeps its expectation.
    """
    (a, sa, xa), (b, sb, xb) = held, came
    up, down = min(sa * (1 - xa), sb * xb), min(sa * xa, sb * (1 - xb))
    if draw * (up + down) < down:  # mass moves from b to a
        xa, xb = xa + up / sa, xb - up / sb
    else:
        xa, xb = xa - down / sa, xb + down / sb
    done, left = [], None
    for row, size, x in ((a, sa, xa), (b, sb, xb)):
        if x <= _EPS or x >= 1 - _EPS:
            done.append((row, round(x)))
        else:
            left = (row, size, x)
    return done, left


_OUT = pa.schema([
    ("row", pa.int64()), ("id", pa.int64()), ("source", pa.string()), ("size", pa.int64()), ("leaf", pa.int64()),
    ("base", pa.int64()), ("x", pa.float64()), ("copies", pa.int64()),
])
_OUT_DDL = "row long, id long, source string, size long, leaf long, base long, x double, copies long"


def _round(seed: int, last: bool):
    """Task side: rows sorted by (leaf, source, size down, id); holds one fractional row."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            group, held = None, None  # held: (row, size, x)
            for batch in parts:
                for row in zip(*(values(batch, c) for c in
                                 ("row", "id", "source", "size", "leaf", "base", "x"))):
                    _, doc_id, source, size, leaf, base, x = row
                    if (leaf, source) != group:
                        if held:
                            yield finish(held)
                        group, held = (leaf, source), None
                    if x <= _EPS or x >= 1 - _EPS:
                        yield *row[:6], None, base + round(x)
                    elif not size:  # has no words to exchange
                        yield *row[:6], None, base + (_uniform(seed, doc_id, source) < x)
                    elif held is None:
                        held = (row, size, x)
                    else:
                        done, held = exchange(
                            held, (row, size, x), _uniform(seed, held[0][1], doc_id))
                        for r, one in done:
                            yield *r[:6], None, r[5] + one
            if held:
                yield finish(held)

        def finish(held: tuple) -> tuple:
            row, _, x = held
            if last:
                return *row[:6], None, row[5] + (_uniform(seed, row[1], row[2]) < x)
            return *row[:6], x, None

        yield from batches(rows(), _OUT)

    return run


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    ceiling: float = CEILING,
    seed: int = SEED,
    rows_per_leaf: int = ROWS_PER_LEAF,
    fan_in: int = FAN_IN,
    row_col: str | None = None,
) -> DataFrame:
    """One row per input row: row, id, source, size, source_size, target, copies, taken.

    ``row`` hands on a long column of the input (``row_col``) that tells rows
    of one id apart; it is null without.

    ``size`` is the number of words (0 for null), ``taken`` is ``copies *
    size``.  A null source is a source of its own, ranked last.  Documents
    without words are rounded on their own: they move no target.  Rows that
    repeat an id are rounded like any others; equal rows are interchangeable.
    Of equal sizes, null ids come first.  A corpus without words takes no words
    (copies 0); an empty table gives no rows.
    """
    spark = df.sparkSession
    sized = stage(
        df.select((df[row_col] if row_col else F.lit(None)).cast("long").alias("row"),
                  df[id_col].cast("long").alias("id"),
                  df[source_col].cast("string").alias("source"),
                  n_words(df[text_col].cast("string")).alias("size")),
        "mix_sizes",
    )
    n = sized.count()
    targets = source_targets(sized, weights, share, ceiling)
    leaves = max(1, math.ceil(n / rows_per_leaf))
    wish = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(
        F.lit(0.0))
    # floor, unless rounding noise sits just below an integer
    base = F.floor(wish + F.lit(_EPS)).cast("long")
    todo = (
        sized.join(targets.withColumnRenamed("source", "of"),
                   F.col("source").eqNullSafe(F.col("of")))
        .select("row", "id", "source", "size",
                F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(leaves)).alias("leaf"),
                base.alias("base"), F.greatest(wish - base, F.lit(0.0)).alias("x"))
    )
    parts: list[DataFrame] = []
    while True:
        last = leaves == 1
        out = stage(
            todo.repartition(max(1, min(leaves, 20_000)) if leaves > 1 else
                             min(shuffle_partitions(spark), 64), "leaf", "source")
            .sortWithinPartitions("leaf", "source", F.desc("size"), "id", "x", "row")
            .mapInArrow(_round(seed, last), _OUT_DDL),
            "mix_level",
        )
        parts.append(out.filter("copies is not null").select("row", "id", "source", "size", "copies"))
        if last:
            break
        leaves = math.ceil(leaves / fan_in)
        todo = out.filter("copies is null").select(
            "row", "id", "source", "size", F.floor(F.col("leaf") / fan_in).alias("leaf"), "base", "x")
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    return rows.join(
        targets.select(F.col("source").alias("of"), "source_size", "target"),
        F.col("source").eqNullSafe(F.col("of")),
    ).select("row", "id", "source", "size", "source_size", "target", "copies",
             (F.col("copies") * F.col("size")).alias("taken"))
