"""Importance resampling towards a target, ranked by sorting with regular samples.

Every feature (a run of words) falls in a bucket.  How much more frequent a
bucket is in the target than in the documents is its gain; the gains of all
buckets are one array of a fixed length, and a document's weight is the sum of
what its features look up there.  A hash of the document's id adds Gumbel noise,
so the largest scores are a draw without replacement by weight.

Scores are ranked by parallel sorting by regular sampling.  Every task sorts
its rows and writes them as a run.  Rows at regular distances of every run are
the sample; regular members of the sorted sample are the splitters.  The rows
between two splitters come together, a task merges them and counts, and the
counts of the segments before give every row its exact rank.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, binary, id_text, shuffle_partitions, stage, values

GRAMS = (1, 1)
BUCKETS = 10_000
#: Share of the documents that is drawn.
SHARE = (10, 100)
LEAST_WORDS = 20
SEED = 2024
#: Rows of a segment that the number of segments aims at, and most segments
#: (the driver holds the square of their number in sampled rows).
SEGMENT_ROWS = 1_000_000
MOST_SEGMENTS = 1_000

#: What is no letter A-Z, a-z, digit or part of a character beyond ASCII becomes a space.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def word_list(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def features(words: list[bytes], grams: tuple[int, int]) -> Iterator[bytes] | list[bytes]:
    """All runs of the given numbers of consecutive words, joined by one space."""
    if grams == (1, 1):
        return words
    return (b" ".join(words[k:k + n]) for n in range(grams[0], grams[1] + 1)
            for k in range(len(words) - n + 1))


class Lookup(dict):
    """What an array has for a feature; kept while a task runs, up to a number of features."""

    def __init__(self, array: list[int]):
        super().__init__()
        self.array = array

    def __missing__(self, feature: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[feature] = self.array[crc32(feature) % len(self.array)]
        return value


def bucket_counts(df: DataFrame, text_col: str, grams: tuple[int, int], buckets: int) -> np.ndarray:
    """Features per bucket over all rows (``buckets`` numbers reach the driver)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, of = np.zeros(buckets, dtype=np.int64), Lookup(list(range(buckets)))
        for batch in parts:
            for text in binary(batch, "text"):
                found = features(word_list(text), grams)
                at = np.fromiter(map(of.__getitem__, found), dtype=np.int64)
                counts += np.bincount(at, minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int64()),
                                          "n": pa.array(counts[some], pa.int64())})

    text = df.select(F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"))
    out = np.zeros(buckets, dtype=np.int64)
    summed = text.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in summed.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """Gain of every bucket in thousandths, rounded down."""
    n, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return [
        math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
        for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist())
    ]


def noise(doc_id: int, seed: int) -> int:
    """Gumbel noise in thousandths, rounded down, from a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


_SCORED = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()),
                     ("weight", pa.int64()), ("score", pa.int64())])
_SCORED_DDL = "id long, n_words long, n_features long, weight long, score long"


def scores(docs: DataFrame, gain: list[int], grams: tuple[int, int], seed: int) -> DataFrame:
    """``id, n_words, n_features, weight, score`` of every row of ``id, text``."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            of = Lookup(gain)
            for batch in parts:
                for doc_id, text in zip(values(batch, "id"), binary(batch, "text")):
                    words = word_list(text)
                    found = list(features(words, grams))
                    weight = sum(map(of.__getitem__, found))
                    yield (doc_id, len(words), len(found), weight,
                           None if doc_id is None else weight + noise(doc_id, seed))

        yield from batches(rows(), _SCORED)

    return docs.mapInArrow(run, _SCORED_DDL)


def _segments(splitters: list[tuple[int, int]]):
    """Task side: the segment of every row, by (-score, id)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            at = [bisect.bisect_right(splitters, (-s, i))
                  for s, i in zip(values(batch, "score"), values(batch, "id"))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at, pa.int32())], names=[*batch.schema.names, "segment"])

    return run


def ranks(scored: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``row, rank`` of rows ``row, id, score``: 1, 2, 3... by falling score, ties by
    the smaller id, then the smaller row."""
    spark = scored.sparkSession
    runs = stage(
        scored.select("row", "id", "score").sortWithinPartitions(F.desc("score"), "id", "row")
        .withColumn("run", F.spark_partition_id())
        # the position in the sorted run: the lower bits count within a partition
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "importance_runs",
    )
    total = runs.count()
    n = min(MOST_SEGMENTS, max(shuffle_partitions(spark), -(-total // segment_rows)))
    every = max(1, total // (n * n))
    sample = sorted(
        (-r["score"], r["id"]) for r in
        runs.filter(F.pmod(F.col("place"), F.lit(every)) == every // 2).select("score", "id").collect()
    )
    splitters = sorted({sample[len(sample) * k // n] for k in range(1, n)}) if sample else []
    parted = stage(
        runs.select("row", "id", "score").mapInArrow(
            _segments(splitters), "row long, id long, score long, segment int"),
        "importance_segments")
    before = parted.groupBy("segment").agg(F.count("row").alias("n")).select(
        F.col("segment").alias("of"),
        # one row per segment, at most MOST_SEGMENTS
        (F.sum("n").over(Window.orderBy("segment")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("segment").orderBy(F.desc("score"), "id", "row")
    return (
        parted.withColumn("inside", F.row_number().over(inside))
        .join(F.broadcast(before), F.col("segment") == F.col("of"))
        .select("row", (F.col("before") + F.col("inside")).alias("rank"))
    )


def resample(
    df: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    grams: tuple[int, int] = GRAMS,
    buckets: int = BUCKETS,
    share: tuple[int, int] = SHARE,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """One row per input row: id, n_features, weight, score, rank.

    Of the documents with at least ``least_words`` words the ``share`` (numerator,
    denominator, rounded down) with the highest scores is drawn; ``rank`` counts
    the drawn ones from 1 and is null elsewhere.  Ties go to the smaller id, of
    repeated rows to either.  Null and empty texts have no features and weight 0.
    A null id has no noise: its score is null and it is never drawn nor counted
    among those to draw from.  Very long texts are whole features of one row and
    need no more than their words in memory.  An empty target gives every bucket
    its gain from the documents alone; an empty table gives no rows.  Other
    columns, whatever their names, are not read.
    """
    docs = id_text(df, id_col, text_col)
    gain = gains(bucket_counts(docs, "text", grams, buckets),
                 bucket_counts(target, target_col, grams, buckets))
    scored = stage(
        scores(docs, gain, grams, seed).withColumn("row", F.monotonically_increasing_id()),
        "importance_scores")
    able = scored.filter((F.col("n_words") >= least_words) & F.col("score").isNotNull())
    n = share[0] * able.count() // share[1]
    drawn = ranks(able, segment_rows).filter(F.col("rank") <= n).withColumnRenamed("row", "of")
    return scored.join(drawn, F.col("row") == F.col("of"), "left").select(
        "id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
