"""Periodic runs of words, by tiles of every period octave.

A run is a stretch of words that repeats with its smallest period at least twice
and that no neighbouring word continues.  A document is exploded into tiles, for
every octave of periods [B, 2B) of its own: tiles overlap by 4B words (and by the least
length of a run), so what two neighbouring tiles have of one run overlaps by the
period or more, and any two runs of one period overlap by less than the period.

A tile is solved on its own.  Blocks of words at fixed distances are its
boundaries; a run's first half holds a whole block, which stands again one
period later.  At such a boundary the Z-function of the words from it on, and
of the reversed words before it, give for every period at once how far the
repetition reaches forward and back.  Fragments are shuffled by document and
period and stitched where they overlap by the period or more.

Tiles of a document up to ``spread`` words are solved in the task that reads it;
a longer document's tiles are rows of their own that are dealt to all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, binary, id_text, shuffle_partitions, stage, values

#: Least length of a run in words, besides twice its period.
LEAST = 12
#: Words by which neighbouring tiles of the small octaves are apart.
STRIDE = 8_192
#: Words of a document whose tiles stay in the task that reads it.
SPREAD = 100_000

Edit = Callable[[list[bytes], int], list[bytes]]

_ODD = np.uint64(0x9E3779B97F4A7C15)


def octaves(n: int, least: int = LEAST) -> list[tuple[int, int]]:
    """``(B, block)`` of every octave of periods that ``n`` words can repeat twice."""
    out, low = [], 1
    while 2 * low <= n:
        # a run's first half, at its shortest over the octave's periods, holds a
        # whole aligned block of so many words
        half = min(max(q, least - q) for q in range(low, min(2 * low, low + least)))
        block = 1
        while 4 * block - 1 <= half:
            block *= 2
        out.append((low, block))
        low *= 2
    return out


def tiles(n: int, low: int, least: int = LEAST, stride: int = STRIDE) -> list[tuple[int, int]]:
    """``(start, end)`` of the tiles of an octave.  What neighbours share holds any
    part of a run that is long enough to be one."""
    both = max(4 * low, least)
    step = max(stride, both)
    out, start = [], 0
    while True:
        end = min(n, start + step + both)
        out.append((start, end))
        if end == n:
            return out
        start += step


def z_function(s: list[int]) -> list[int]:
    """For every position the length of the longest common prefix with the whole."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


def common_prefix(a: np.ndarray, b: np.ndarray) -> int:
    """Words that two stretches have in common from their start on."""
    n, done, step = min(len(a), len(b)), 0, 256
    while done < n:
        to = min(n, done + step)
        differ = a[done:to] != b[done:to]
        if differ.any():
            return done + int(differ.argmax())
        done, step = to, step * 4
    return n


def primitive(words: np.ndarray, period: int) -> bool:
    """Whether two periods' words have no smaller period (it would divide this one)."""
    two, left, p = words[:2 * period], period, 2
    while left > 1:
        if p * p > left:
            p = left
        if left % p == 0:
            d = period // p
            if np.array_equal(two[d:], two[:-d]):
                return False
            while left % p == 0:
                left //= p
        p += 1
    return True


class Blocks:
    """Hashes of all stretches of 1, 2, 4, ... words, doubled as they are asked for."""

    def __init__(self, words: np.ndarray):
        with np.errstate(over="ignore"):
            h = (words.astype(np.uint64) + np.uint64(1)) * _ODD
            self.of = {1: (h ^ (h >> np.uint64(29))) * _ODD}

    def __call__(self, block: int) -> np.ndarray:
        if block not in self.of:
            half = self(block // 2)
            with np.errstate(over="ignore"):
                h = half[:-(block // 2)] * _ODD + half[block // 2:]
                self.of[block] = h ^ (h >> np.uint64(31))
        return self.of[block]


def solve(words: np.ndarray, low: int, block: int, blocks: Blocks | None = None
          ) -> list[tuple[int, int, int]]:
    """``(period, start, end)``: every stretch of a tile with a smallest period in
    [low, 2 low), of at least two periods, as far as the tile goes."""
    n = len(words)
    if n < 2 * low:
        return []
    h = (blocks or Blocks(words))(block)
    m = len(h)
    if m <= low:
        return []
    # boundary c (a row) against c + low ... c + 2 low - 1 (its columns)
    ahead = np.zeros(m + 2 * low + block, dtype=np.uint64)
    ahead[:m] = h
    marks = np.arange(0, m - low, block)
    seen = np.lib.stride_tricks.as_strided(
        ahead[low:], (len(marks), low), (block * 8, 8), writeable=False)
    equal = seen == h[marks][:, None]
    out: list[tuple[int, int, int]] = []
    reached: dict[int, int] = {}
    for row in np.flatnonzero(equal.any(axis=1)).tolist():
        c = row * block
        open_ = [q for q in (np.flatnonzero(equal[row]) + low).tolist()
                 if c + q + block <= n and reached.get(q, 0) < c + q + block]
        if not open_:
            continue
        # Z-functions of both sides of the boundary, at most 4 low words either way
        side = 4 * low
        forward = z_function(words[c:c + side].tolist())
        before = words[max(0, c - 2 * low):c][::-1].tolist()
        past = words[max(0, c - 2 * low):c + 2 * low][::-1].tolist()
        back = z_function([*before, -1, *past])
        for q in open_:
            after = forward[q]
            if q + after == len(forward):  # on beyond the side
                after += common_prefix(words[c + after:], words[c + q + after:])
            behind = back[1 + len(past) - q]
            if behind == len(before) < c:
                behind += common_prefix(words[:c - behind][::-1], words[:c + q - behind][::-1])
            reached[q] = c + q + after
            if after + behind >= q and primitive(words[c - behind:], q):
                out.append((q, c - behind, c + q + after))
    return out


def fragments(words: np.ndarray, least: int = LEAST, stride: int = STRIDE
              ) -> Iterator[tuple[int, int, int]]:
    """Fragments ``(period, start, end)`` of all tiles of a document."""
    n, whole = len(words), None
    if n < max(2, least):
        return
    for low, block in octaves(n, least):
        for start, end in tiles(n, low, least, stride):
            if end - start == n:
                whole = whole or Blocks(words)
                found = solve(words, low, block, whole)
            else:
                found = solve(words[start:end], low, block)
            for q, a, z in found:
                if z - a >= least:
                    yield q, start + a, start + z


def word_ids(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64,
                       count=len(words))


_PARTS = pa.schema([
    ("row", pa.int64()), ("id", pa.int64()), ("n_words", pa.int64()), ("sha", pa.binary()),
    ("content", pa.binary()), ("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
    ("low", pa.int64()), ("words", pa.binary())])
_PARTS_DDL = ("row long, id long, n_words long, sha binary, content binary, period long, "
              "start long, end long, low long, words binary")


def _explode(least: int, stride: int, spread: int, edit: Edit | None, with_text: bool):
    """Task side over ``row, id, text``: of every document one row with its word
    count and the hash of its words joined by one space, which are the content
    where it may have runs; its fragments; the tiles of a long document."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in parts:
                for row, doc_id, text in zip(
                        values(batch, "row"), values(batch, "id"), binary(batch, "text")):
                    words = text.split()
                    if edit and doc_id is not None:
                        words = edit(words, doc_id)
                    ids, n = word_ids(words), len(words)
                    found: list = []
                    if n > spread:
                        for low, _ in octaves(n, least):
                            for start, end in tiles(n, low, least, stride):
                                yield (row, None, n, None, None, None, start, end, low,
                                       ids[start:end].astype(np.int32).tobytes())
                    else:
                        found = list(fragments(ids, least, stride))
                    for q, start, end in found:
                        yield row, None, None, None, None, q, start, end, None, None
                    content = b" ".join(words)
                    yield (row, doc_id, n, hashlib.sha256(content).digest(),
                           content if found or n > spread or with_text else None,
                           None, None, None, None, None)

        yield from batches(rows(), _PARTS, most_rows=10_000, most_bytes=8 << 20)

    return run


_FOUND = pa.schema([("row", pa.int64()), ("period", pa.int64()), ("start", pa.int64()),
                    ("end", pa.int64())])


def _solve_tiles(least: int):
    """Task side over dealt tiles of long documents."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in parts:
                for row, start, low, words in zip(*(values(batch, c) for c in (
                        "row", "start", "low", "words"))):
                    block = dict(octaves(2 * low, least))[low]
                    ids = np.frombuffer(words, dtype=np.int32).astype(np.int64)
                    for q, a, z in solve(ids, low, block):
                        if z - a >= least:
                            yield row, q, start + a, start + z

        yield from batches(rows(), _FOUND)

    return run


def stitch(found: DataFrame, least: int = LEAST) -> DataFrame:
    """Runs ``row, start, length, period`` from fragments ``row, period, start, end``:
    those of one document and period that overlap by the period or more are one."""
    series = Window.partitionBy("row", "period").orderBy("start", "end")
    before = series.rowsBetween(Window.unboundedPreceding, -1)
    new = F.coalesce(F.col("start") > F.max("end").over(before) - F.col("period"), F.lit(True))
    numbered = found.withColumn("new", new.cast("long")).withColumn(
        "part", F.sum("new").over(series.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("row", "period", "part").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    return whole.select("row", "start", (F.col("end") - F.col("start")).alias("length"), "period"
                        ).filter(F.col("length") >= least)


def _collapse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task side: ``row, content, runs`` to the words that no run repeats."""
    schema = pa.schema([("row", pa.int64()), ("collapsed", pa.binary())])

    def rows() -> Iterator[tuple]:
        for batch in parts:
            for row, content, runs in zip(values(batch, "row"), binary(batch, "content"),
                                          values(batch, "runs")):
                words = content.split(b" ")
                depth = np.zeros(len(words) + 1, dtype=np.int64)
                for r in runs:
                    depth[r["start"] + r["period"]] += 1
                    depth[r["start"] + r["length"]] -= 1
                kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()
                yield row, b" ".join([words[k] for k in kept])

    yield from batches(rows(), schema, most_rows=5_000)


def periodic_runs(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    stride: int = STRIDE,
    spread: int = SPREAD,
    edit: Edit | None = None,
    with_text: bool = False,
) -> DataFrame:
    """One row per input row: id, n_words, n_runs, start, length, period,
    exponent_milli, runs_sha256, collapsed_sha256.

    A run has its smallest period q, at least ``max(least, 2 q)`` words, and no
    neighbouring word that goes on with the period.  The longest one (ties: the
    smallest start, then period) is described; without a run the four numbers are
    null.  A word is dropped from the collapsed text if a run contains it after
    that run's first q words.  ``edit`` (words, id) gives the words to look at
    instead of a document's own, unless its id is null.  With ``with_text`` also
    the runs (start, length, period) and the collapsed text.  Null text has no
    words, an empty one neither.  A very long text's
    tiles are solved by many tasks; its words and runs are one row.  Repeated
    rows and ids, null ids too, are told apart by a row number.  Other columns,
    whatever their names, are not read; an empty table gives no rows.
    """
    rows = id_text(df, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    parts = stage(rows.select("row", "id", "text").mapInArrow(
        _explode(least, stride, spread, edit, with_text), _PARTS_DDL), "periodic_parts")
    docs = parts.filter("sha is not null").select(
        "row", "id", "n_words", "sha", *(["content"] if with_text else []))
    found = parts.filter("period is not null").select("row", "period", "start", "end")
    tiled = parts.filter("low is not null").select("row", "start", "low", "words")
    if not tiled.isEmpty():
        dealt = tiled.repartition(shuffle_partitions(df.sparkSession), "row", "low", "start")
        found = found.unionByName(stage(
            dealt.mapInArrow(_solve_tiles(least), "row long, period long, start long, end long"),
            "periodic_found"))
    runs = stage(
        stitch(found, least).groupBy("row").agg(
            F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"),
            F.max_by(F.struct("start", "length", "period"),
                     F.struct("length", -F.col("start"), -F.col("period"))).alias("best"))
        .select(F.col("row").alias("of"), "runs", "best"), "periodic_runs")
    texts = parts.filter("content is not null").select("row", "content")
    collapsed = texts.join(runs, F.col("row") == F.col("of")).select("row", "content", "runs") \
        .mapInArrow(_collapse, "row long, collapsed binary") \
        .select(F.col("row").alias("c_row"), F.sha2("collapsed", 256).alias("c_sha"),
                *([F.col("collapsed").cast("string").alias("c_text")] if with_text else []))
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    lines = F.coalesce(F.concat(F.array_join(line, "\n"), F.lit("\n")), F.lit(""))
    out = docs.join(runs, F.col("row") == F.col("of"), "left").join(
        collapsed, F.col("row") == F.col("c_row"), "left")
    cols = [
        F.col("id"), F.col("n_words"),
        F.coalesce(F.size("runs"), F.lit(0)).cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.coalesce("c_sha", F.lower(F.hex("sha"))).alias("collapsed_sha256"),
    ]
    if with_text:
        cols += [F.coalesce("runs", F.array()).alias("runs"),
                 F.coalesce("c_text", F.col("content").cast("string")).alias("collapsed")]
    return out.select(*cols)
