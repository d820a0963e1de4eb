"""Document fingerprints by winnowing.

Every k-gram of characters is hashed with a polynomial that rolls over the
text (computed for all positions at once, by joining the hashes of halves).
From every window of ``WINDOW`` consecutive k-grams the smallest hash is
selected, of equal ones the rightmost, and its position is kept.  Two texts
that share any ``GRAM + WINDOW - 1`` characters in a row therefore share a
selected hash, and neighbouring selected positions are at most ``WINDOW``
apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, id_text, shuffle_partitions, stage, values

GRAM = 8
WINDOW = 32
#: A short text has windows of a part of its grams, so that it has several of them.
PART = 8
#: Windows worked on at a time, which bounds the arrays for a very long text.
BLOCK = 1 << 17
#: Ranges of ids dealt to a task, most ranges, and the sample of ids they come from.
RANGES_A_TASK, MOST_RANGES = 4, 100_000
ROWS_A_RANGE, MOST_SAMPLED = 50, 1_000_000
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def gram_hashes(codes: np.ndarray, k: int, base: int = _BASE) -> np.ndarray:
    """Mixed polynomial hash of every k-gram of codes (characters, word hashes)."""
    codes = codes.astype(np.uint64) + np.uint64(1)
    h, size = codes, 1
    for bit in bin(k)[3:]:  # double the length, then add one where the bit says so
        h = h[:len(h) - size] * np.uint64(pow(base, size, 1 << 64)) + h[size:]
        size *= 2
        if bit == "1":
            h = h[:len(h) - 1] * np.uint64(base) + codes[size:]
            size += 1
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def window_minima(h: np.ndarray, window: int) -> np.ndarray:
    """For every window the position of its smallest hash, rightmost of equals."""
    at, least, size = np.arange(len(h)), h, 1
    while size < window:
        step = min(size, window - size)
        right = least[step:] <= least[:-step]
        at = np.where(right, at[step:], at[:-step])
        least = np.minimum(least[step:], least[:-step])
        size += step
    return at


def winnow(text: str, k: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Selected hashes and their positions.  A text with less than ``PART *
    window`` grams has smaller windows, which only adds hashes: what two texts
    share under the larger of their windows both select.  A text shorter than a
    gram is one gram; an empty text has none."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = min(k, len(codes))
    grams = len(codes) - k + 1
    window = min(window, max(1, grams // PART))
    hashes, places = [], []
    for a in range(0, grams - window + 1, BLOCK):
        b = min(a + BLOCK, grams - window + 1)  # windows a..b
        h = gram_hashes(codes[a:b + window + k - 2], k)
        at = np.unique(window_minima(h, window))
        hashes.append(h[at])
        places.append(at + a)
    where, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[first], where


def written(hashes: np.ndarray, places: np.ndarray) -> str:
    """Hex of each selected hash's upper 32 bits and its distance from the last
    position (one byte: windows are under 256)."""
    out = np.zeros(len(hashes), dtype=[("hash", ">u4"), ("step", "u1")])
    out["hash"] = (hashes >> np.uint64(32)).astype(np.uint32)
    out["step"] = np.diff(places, prepend=0)
    return out.tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared share of two fingerprints' distinct hashes; 1 if both are empty."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    every = len(a) + len(b) - both
    return both / every if every else 1.0


_FIELDS = [
    ("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
_DDL = (
    "id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compared(doc_id, text: str, own: tuple, after: str, after_own: tuple) -> tuple:
    half = len(text) // 2
    edited = text[:len(text) - half] + after[:half]
    new = winnow(edited)
    return (
        doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(*own),
        written(*new), likeness(own[0], new[0]), likeness(own[0], after_own[0]),
    )


def _along(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task side: whole ranges in order, each with the first row of the next
    range behind it (``tail``), which every last row meets and which isn't
    itself given out."""

    def rows() -> Iterator[tuple]:
        held = None
        for batch in parts:
            for doc_id, text, tail in zip(*(values(batch, c) for c in ("id", "text", "tail"))):
                own = winnow(text)
                if held is not None:
                    yield _compared(*held, text, own)
                held = None if tail else (doc_id, text, own)

    yield from batches(rows(), pa.schema(_FIELDS), most_rows=2_000)


def _ranged(bounds: np.ndarray):
    """Task side: the columns as they are, and the range of each row's id (0 for null)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            ids = batch.column(batch.schema.get_field_index("id"))
            where = 1 + np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), "right")
            where = np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, where)
            yield pa.RecordBatch.from_arrays(
                batch.columns + [pa.array(where, pa.int64())],
                schema=batch.schema.append(pa.field("range", pa.int64())))

    return run


def _bounds(ids: DataFrame, ranges: int) -> np.ndarray:
    """Ids that cut the table into about equal ranges, from a sample of a fixed
    size (the ids with the smallest hashes, so the same on every run)."""
    n = min(ROWS_A_RANGE * ranges, MOST_SAMPLED)
    sample = ids.filter("id is not null").orderBy(F.xxhash64("id"), "id").limit(n).toArrow()
    found = np.unique(sample.column("id").to_numpy())
    return np.unique(found[np.arange(1, ranges) * len(found) // ranges]) if len(found) else found


def fingerprint_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text has its last half replaced by the start of the next row's
    text; the next row is the one behind it by id (nulls first), equal ids by
    text, and the first row for the last.  A single row is its own next.  Null
    text counts as empty.  Equal texts have equal fingerprints, repeated rows
    included.  Other columns are not read; an empty table gives no rows.

    Rows are dealt by ranges of ids, so neighbours meet inside a task; the first
    row of every range also goes to the range before it.
    """
    spark = df.sparkSession
    n = shuffle_partitions(spark)
    docs = id_text(df, id_col, text_col)
    ids = docs.select("id")
    ranged = _ranged(_bounds(ids, min(RANGES_A_TASK * n, MOST_RANGES)))
    # one row per range (at most MOST_RANGES): its first id, and the range before it
    order = Window.orderBy("range")
    firsts = stage(
        ids.mapInArrow(ranged, "id long, range long").groupBy("range")
        .agg(F.min("id").alias("first"))
        .select("first", F.col("range").alias("of"), F.coalesce(
            F.lag("range").over(order),
            F.max("range").over(order.rowsBetween(Window.unboundedPreceding,
                                                  Window.unboundedFollowing))).alias("before")),
        "winnow_ranges",
    )
    dealt = docs.mapInArrow(ranged, "id long, text string, range long")
    tails = (
        docs.join(F.broadcast(firsts), F.col("id").eqNullSafe(F.col("first")))
        .groupBy("id", "before").agg(F.min("text").alias("text"))
        .select("id", "text", F.col("before").alias("range"), F.lit(1).alias("tail"))
    )
    return (
        dealt.select("id", "text", "range", F.lit(0).alias("tail")).unionByName(tails)
        .repartition(n, "range")
        .sortWithinPartitions("range", "tail", "id", "text")
        .mapInArrow(_along, _DDL)
    )
