"""Substring deduplication by relative Lempel-Ziv parsing.

Every document is parsed against the documents with smaller ids.  The index
holds their blocks: all windows of ``LEAST`` consecutive words, each under the
smallest id that has it.  A factor is a maximal run of a document's windows
that one earlier document has, so it is ``LEAST`` words long or longer; where a
factor ends, the windows across its boundary are looked up as well, so nothing
that an earlier document has is missed.  Factors are duplicate spans and their
words are removed; the rest are literals.

A window is found in the index by its anchor, the smallest hash among its
``GRAM``-word grams (equal windows have equal anchors at equal offsets), and
consecutive windows with one anchor travel as one record: anchor, offset and
their hashes, 128 bits a window together.  Records meet in one shuffle by
anchor, sorted by id, so the first that brings a window is its smallest id.

Where very many documents share a passage, each task resolves what it has seen
in a smaller id itself before the shuffle and deals these records by their
document, so that an anchor's task gets the rest: about one record of every sending
task for each way the passage is cut.  A reading task holds a bounded number
of distinct windows of an anchor; windows beyond go to an aggregate and a join
of their own, which Spark can split.

A resolved record names the smallest id that its task has seen, which need not be
the smallest of all.  So the removed words are the same however rows are dealt,
and the earlier document that a factor names (and with it where one factor
ends and the next begins) is one that has its words, not always the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, binary, id_text, shuffle_partitions, stage, values
from .winnowing import gram_hashes, window_minima

LEAST = 50
GRAM = 16
#: Records a sending task remembers, windows of one anchor a reading task holds.
SENT = 100_000
HELD = 1_000_000
_ANCHOR_BASE, _WINDOW_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_NO_ID = 1 << 63  # a null id comes after all others

_RECORD = pa.schema([
    ("anchor", pa.int64()), ("id", pa.int64()), ("h", pa.int64()), ("start", pa.int64()),
    ("offset", pa.int32()), ("windows", pa.binary()), ("n", pa.int64()), ("ref", pa.int64()),
])
_RECORD_DDL = (
    "anchor long, id long, h long, start long, offset int, windows binary, n long, ref long"
)
_RUN = pa.schema([
    ("id", pa.int64()), ("h", pa.int64()), ("start", pa.int64()), ("n", pa.int64()),
    ("ref", pa.int64()), ("anchor", pa.int64()), ("key", pa.int64()),
])
_RUN_DDL = "id long, h long, start long, n long, ref long, anchor long, key long"


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def records(words: list[bytes], least: int, gram: int) -> Iterator[tuple[int, int, int, bytes]]:
    """``(anchor, start, offset, window hashes)`` of a document's windows: those
    from ``start`` on that share an anchor, which is ``offset`` words behind it."""
    if len(words) < least:
        return
    hashes = word_hashes(words)
    grams = gram_hashes(hashes, gram, _ANCHOR_BASE)
    windows = gram_hashes(hashes, least, _WINDOW_BASE)
    at = window_minima(grams, least - gram + 1)
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
    places = at[cuts[:-1]]
    anchors = grams[places].view(np.int64).tolist()
    for anchor, place, a, b in zip(anchors, places.tolist(), cuts, cuts[1:]):
        yield anchor, a, place - a, windows[a:b].tobytes()


def _send(least: int, gram: int, sent: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            young: dict[tuple, int] = {}
            old: dict[tuple, int] = {}
            for batch in parts:
                for doc_id, h, text in zip(values(batch, "id"), values(batch, "h"),
                                           binary(batch, "text")):
                    own = _NO_ID if doc_id is None else doc_id
                    for anchor, start, offset, windows in records(text.split(), least, gram):
                        key = (anchor, offset, windows)
                        first = young.get(key)
                        if first is None:
                            first = old.get(key, own)
                            if len(young) >= sent // 2:
                                old, young = young, {}
                            young[key] = first
                        if first < own:  # a smaller id has gone out with the same windows
                            # nothing is left to look up, so it is dealt by its document
                            dealt = h ^ start if doc_id is None else doc_id
                            yield (dealt, doc_id, h, start, offset, None, len(windows) // 8, first)
                            continue
                        young[key] = own
                        yield anchor, doc_id, h, start, offset, windows, len(windows) // 8, None

        yield from batches(rows(), _RECORD)

    return run


def _meet(held: int):
    """Task side: records sorted by (anchor, id).  Gives runs of windows that a
    smaller id has, and single windows (``key``) beyond the bound."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[int, int] = {}

        def looked_up(row: tuple) -> Iterator[tuple]:
            anchor, doc_id, h, start, offset, windows = row
            own = _NO_ID if doc_id is None else doc_id
            hashes = np.frombuffer(windows, dtype=np.uint64)
            offsets = (offset - np.arange(len(hashes))).astype(np.uint64)
            keys = (hashes ^ (offsets * np.uint64(_ANCHOR_BASE))).view(np.int64).tolist()
            begun, ref = None, None
            for k, key in enumerate(keys):
                found = first.get(key)
                if found is None:
                    if len(first) < held:
                        first[key] = own
                    else:
                        yield doc_id, h, start + k, None, None, anchor, key
                hit = found if found is not None and found < own else None
                if hit != ref:
                    if ref is not None:
                        yield doc_id, h, start + begun, k - begun, ref, None, None
                    begun, ref = k, hit
            if ref is not None:
                yield doc_id, h, start + begun, len(keys) - begun, ref, None, None

        def rows() -> Iterator[tuple]:
            last, waiting = None, None  # a record alone under its anchor isn't looked at
            for batch in parts:
                for anchor, doc_id, h, start, offset, windows, n, ref in zip(*(
                    values(batch, c) for c in _RECORD.names
                )):
                    if windows is None:
                        yield doc_id, h, start, n, ref, None, None
                        continue
                    row = (anchor, doc_id, h, start, offset, windows)
                    if anchor != last:
                        first.clear()
                        last, waiting = anchor, row
                        continue
                    if waiting:
                        yield from looked_up(waiting)
                        waiting = None
                    yield from looked_up(row)

        yield from batches(rows(), _RUN)

    return run


def duplicate_runs(docs: DataFrame, least: int, gram: int, sent: int, held: int) -> DataFrame:
    """``id, h, start, n, ref``: ``n`` windows from word ``start`` on that the
    document ``ref``, of a smaller id, has."""
    spark = docs.sparkSession
    out = stage(
        docs.mapInArrow(_send(least, gram, sent), _RECORD_DDL)
        .repartition(shuffle_partitions(spark), "anchor")
        .sortWithinPartitions("anchor", F.asc_nulls_last("id"))
        .mapInArrow(_meet(held), _RUN_DDL),
        "rlz_runs",
    )
    runs = out.filter("n is not null").select("id", "h", "start", "n", "ref")
    beyond = out.filter("n is null").select("id", "h", "start", "anchor", "key")
    if beyond.isEmpty():
        return runs
    lows = stage(
        beyond.groupBy("anchor", "key").agg(F.min("id").alias("ref"), F.count("key").alias("all"))
        .filter("all > 1 and ref is not null")
        .select(F.col("anchor").alias("a"), F.col("key").alias("k"), "ref"), "rlz_beyond")
    more = beyond.join(lows, (F.col("anchor") == F.col("a")) & (F.col("key") == F.col("k"))).filter(
        "id is null or ref < id")
    return runs.unionByName(more.select("id", "h", "start", F.lit(1).cast("long").alias("n"), "ref"))


def factors(runs: list[dict], least: int) -> list[tuple[int, int, int]]:
    """Greedy parse: ``(start, words, ref)`` from left to right.  Runs that go on
    in the same document are one factor."""
    out: list[tuple[int, int, int]] = []
    for r in sorted(runs, key=lambda r: (r["start"], -r["n"], r["ref"])):
        start, words, ref = r["start"], r["n"] + least - 1, r["ref"]
        if out and out[-1][2] == ref and start <= out[-1][0] + out[-1][1] - least + 1:
            words = max(out[-1][0] + out[-1][1], start + words) - out[-1][0]
            start = out.pop()[0]
        out.append((start, words, ref))
    return out


def _cut(least: int, with_text: bool, schema: pa.Schema):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in parts:
                for doc_id, text, runs in zip(values(batch, "id"), binary(batch, "text"),
                                              values(batch, "runs")):
                    words = text.split()
                    parsed = factors(runs or [], least)
                    depth = np.zeros(len(words) + 1, dtype=np.int64)
                    for start, n, _ in parsed:
                        depth[start] += 1
                        depth[start + n] -= 1
                    gone = np.cumsum(depth[:-1]) > 0
                    kept = words if not parsed else [w for w, g in zip(words, gone.tolist()) if not g]
                    content = b" ".join(kept)
                    yield (
                        doc_id, len(words), len(words) - len(kept),
                        hashlib.sha256(content).hexdigest(), len(parsed),
                        *((content.decode(), [list(f) for f in parsed]) if with_text else ()),
                    )

        yield from batches(rows(), schema, most_rows=5_000)

    return run


def substring_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    gram: int = GRAM,
    sent: int = SENT,
    held: int = HELD,
    with_text: bool = False,
) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256, n_factors.

    A word is removed when a window of ``least`` consecutive words covers it
    whose words also stand in a document with a smaller id; windows are judged
    on the input.  With ``with_text`` also the kept text (words joined by one
    space) and the factors (start, words, id of the earlier document).  Null
    text has no words.  A null id counts as larger than any other; rows of one
    id don't remove each other's words, repeated rows included.  Other columns
    are not read; an empty table gives no rows.
    """
    docs = id_text(df, id_col, text_col).withColumn("h", F.xxhash64("text"))
    runs = duplicate_runs(docs, least, gram, sent, held)
    # a document's runs are at most as many as its words
    per_doc = runs.groupBy("id", "h").agg(
        F.collect_list(F.struct("start", "n", "ref")).alias("runs")
    ).withColumnsRenamed({"id": "r_id", "h": "r_h"})
    fields = [("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
              ("kept_sha256", pa.string()), ("n_factors", pa.int64())]
    ddl = "id long, n_words long, n_removed long, kept_sha256 string, n_factors long"
    if with_text:
        fields += [("kept", pa.string()), ("factors", pa.list_(pa.list_(pa.int64())))]
        ddl += ", kept string, factors array<array<bigint>>"
    return (
        docs.join(per_doc.hint("shuffle_hash"),
                  F.col("id").eqNullSafe(F.col("r_id")) & (F.col("h") == F.col("r_h")), "left")
        .select("id", "text", "runs")
        .mapInArrow(_cut(least, with_text, pa.schema(fields)), ddl)
    )
