"""SimHash near-duplicates, linked through a pigeonring filter.

Two 64-bit fingerprints that differ in at most t bits, cut into t + 1 segments
on a ring, have a segment from which every chain of l consecutive segments
differs in at most ``l * t / (t + 1)`` bits (rounded down: 0, 1, 2, ... t).
Candidates come from the first two links of that chain: one segment equal and
at most one bit of difference in the next, so one half of the next is equal
too.  Equal bits are an index key; the rest of the chain is checked link by
link on what is left, and the full Hamming distance last.

Only distinct fingerprints are linked.  A bucket of the index yields a spanning
forest of its links, not its pairs.  A bucket above ``bucket`` fingerprints is
taken apart by more equal bits (the remaining bits cut into t + 1 parts, one of
which must be equal) and shuffled again, so no bucket is ever too large for a
task and none is cut short.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, binary, id_text, shuffle_partitions, stage, values
from .components import components

SHINGLE = 3
MOST_BITS = 3
SEED = 42
BITS = 64
#: Fingerprints of one bucket held by a task; larger buckets are split.
BUCKET = 200_000
#: Fingerprints compared pair by pair; larger groups are split in the task.
BLOCK = 512


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of a UTF-8 text (``bytes.lower`` and ``split`` are ASCII)."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        n = len(words) - shingle + 1
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    hashes = np.fromiter(
        map(partial(xxhash.xxh64_intdigest, seed=SEED), grams), dtype=np.uint64, count=n)
    counts = np.zeros(BITS, dtype=np.int64)
    for k in range(0, n, 1 << 16):  # bits of a bounded piece at a time
        piece = hashes[k:k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.nonzero(2 * counts > n)[0])


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


_FP = pa.schema([("id", pa.int64()), ("fp", pa.int64())])


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``id, fp`` (the 64 bits as a long), one row per input row."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (doc_id, _signed(fingerprint(text, shingle)))
            for batch in parts
            for doc_id, text in zip(values(batch, "id"), binary(batch, "text"))
        )
        yield from batches(rows, _FP)

    return id_text(df, id_col, text_col).mapInArrow(run, "id long, fp long")


def segments(most_bits: int) -> list[int]:
    """Masks of the ``most_bits + 1`` segments, lowest bits first."""
    return _parts(list(range(BITS)), most_bits + 1)


def _parts(bits: list[int], n: int) -> list[int]:
    cuts = [len(bits) * k // n for k in range(n + 1)]
    return [sum(1 << b for b in bits[a:z]) for a, z in zip(cuts, cuts[1:])]


def _halves(mask: int) -> list[int]:
    return _parts([b for b in range(BITS) if mask >> b & 1], 2)


def index_masks(most_bits: int) -> list[tuple[int, int]]:
    """``(start, mask)`` of every index key: segment ``start`` and a half of the next."""
    seg = segments(most_bits)
    if len(seg) == 1:
        return [(0, seg[0])]
    return [(k, seg[k] | half) for k in range(len(seg)) for half in _halves(seg[(k + 1) % len(seg)])]


def quotas(most_bits: int, start: int) -> list[tuple[int, int]]:
    """Chain from segment ``start``: (mask of its first l segments, bits allowed)."""
    seg = segments(most_bits)
    out, mask = [], 0
    for n in range(len(seg)):
        mask |= seg[(start + n) % len(seg)]
        out.append((mask, (n + 1) * most_bits // len(seg)))
    return out


class Forest:
    """Links within one bucket: a union-find over its fingerprints."""

    def __init__(self, fps: np.ndarray, most_bits: int, start: int):
        self.fps, self.most_bits = fps, most_bits
        self.chain = [(np.uint64(m), q) for m, q in quotas(most_bits, start)]
        self.up = np.arange(len(fps))

    def roots(self, idx: np.ndarray) -> np.ndarray:
        at = self.up[idx]
        while (self.up[at] != at).any():
            at = self.up[at]
        self.up[idx] = at
        return at

    def join(self, idx: np.ndarray) -> None:
        roots = np.unique(self.roots(idx))
        self.up[roots] = roots[0]

    def link(self, idx: np.ndarray, mask: int) -> None:
        """Link what is in ``idx``, whose fingerprints are equal in the bits of ``mask``."""
        roots = self.roots(idx)
        if (roots == roots[0]).all():
            return
        if len(idx) <= BLOCK:
            return self._compare(idx)
        free = [b for b in range(BITS) if not mask >> b & 1]
        for part in _parts(free, self.most_bits + 1):
            keys = self.fps[idx] & np.uint64(part)
            order = np.argsort(keys, kind="stable")
            cuts = np.flatnonzero(np.diff(keys[order])) + 1
            for group in np.split(idx[order], cuts):
                if len(group) > 1:
                    self.link(group, mask | part)

    def _compare(self, idx: np.ndarray) -> None:
        fps = self.fps[idx]
        i, j = np.triu_indices(len(idx), 1)
        differ = fps[i] ^ fps[j]
        # the chain link by link; its last link is the whole Hamming distance
        for mask, most in self.chain:
            near = np.bitwise_count(differ & mask) <= most
            i, j, differ = i[near], j[near], differ[near]
        if not len(i):
            return
        near = np.zeros((len(idx), len(idx)), dtype=bool)
        near[i, j] = near[j, i] = True
        left = np.ones(len(idx), dtype=bool)
        for k in np.unique(i):
            if left[k]:
                reach = front = np.arange(len(idx)) == k
                while front.any():
                    front = near[front].any(axis=0) & ~reach
                    reach = reach | front
                left &= ~reach
                self.join(idx[reach])


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("start", pa.int32()),
                    ("mask", pa.int64()), ("key", pa.int64())])
_LINKS_DDL = "a long, b long, start int, mask long, key long"


def _link(most_bits: int, bucket: int):
    """Task side: rows sorted by (mask, key).  Gives links ``(a, b)``, or of a too
    large bucket its fingerprints ``a`` under keys with more equal bits."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def deeper(fp: int, start: int, mask: int) -> Iterator[tuple]:
            own, bits = fp % (1 << BITS), mask % (1 << BITS)
            free = [b for b in range(BITS) if not bits >> b & 1]
            for part in _parts(free, most_bits + 1):
                yield fp, None, start, _signed(bits | part), _signed(own & (bits | part))

        def links(held: list[int], start: int, mask: int) -> Iterator[tuple]:
            if len(held) == 2:
                differ = (held[0] ^ held[1]) % (1 << BITS)
                if all((differ & m).bit_count() <= q for m, q in quotas(most_bits, start)):
                    yield held[0], held[1], None, None, None
            elif len(held) > 2:
                forest = Forest(np.array(held, dtype=np.int64).view(np.uint64), most_bits, start)
                every = np.arange(len(held))
                forest.link(every, mask % (1 << BITS))
                for k, root in enumerate(forest.roots(every).tolist()):
                    if k != root:
                        yield held[k], held[root], None, None, None

        def rows() -> Iterator[tuple]:
            group, held, over = None, [], False
            for batch in parts:
                for fp, start, mask, key in zip(*(
                    values(batch, c) for c in ("a", "start", "mask", "key")
                )):
                    if (start, mask, key) != group:
                        if group and not over:
                            yield from links(held, group[0], group[1])
                        group, held, over = (start, mask, key), [], False
                    if over:
                        yield from deeper(fp, start, mask)
                        continue
                    held.append(fp)
                    if len(held) > bucket:
                        over = True
                        for one in held:
                            yield from deeper(one, start, mask)
                        held = []
            if group and not over:
                yield from links(held, group[0], group[1])

        yield from batches(rows(), _LINKS)

    return run


def hamming_links(fps: DataFrame, most_bits: int = MOST_BITS, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` between distinct ``fp`` values; two values are connected by
    them exactly when a chain of values, each within ``most_bits`` of the next,
    connects them."""
    spark = fps.sparkSession
    keys = F.array(*[
        F.struct(F.lit(s).cast("int").alias("start"), F.lit(_signed(m)).cast("long").alias("mask"))
        for s, m in index_masks(most_bits)
    ])
    todo = fps.select(F.col("fp").alias("a"), F.explode(keys).alias("k")).select(
        "a", "k.start", "k.mask", F.col("a").bitwiseAND(F.col("k.mask")).alias("key"))
    found = None
    while True:
        out = stage(
            todo.repartition(shuffle_partitions(spark), "start", "mask", "key")
            .sortWithinPartitions("start", "mask", "key", "a")
            .mapInArrow(_link(most_bits, bucket), _LINKS_DDL),
            "simhash_links",
        )
        links = out.filter("b is not null").select("a", "b")
        found = links if found is None else found.unionByName(links)
        todo = out.filter("b is null").select("a", "start", "mask", "key").distinct()
        if todo.isEmpty():
            return found


def simhash_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    most_bits: int = MOST_BITS,
    bucket: int = BUCKET,
) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    Texts link when their fingerprints differ in at most ``most_bits`` bits;
    ``component_id`` is the smallest id reachable over links, its own included.
    Null and wordless texts have fingerprint zero and link like any others.
    Null ids take part, but are no component's smallest id unless all its ids
    are null.  Repeated rows and ids give a row each.  Other columns are not
    read; an empty table gives no rows.
    """
    docs = stage(fingerprints(df, id_col, text_col, shingle), "simhash_fps")
    nodes = stage(docs.groupBy("fp").agg(F.min("id").alias("low")), "simhash_nodes")
    labels = components(hamming_links(nodes, most_bits, bucket))
    labelled = nodes.join(labels, nodes.fp == labels.node, "left").select(
        "fp", "low", F.coalesce("label", "fp").alias("label"))
    lows = labelled.groupBy("label").agg(F.min("low").alias("component_id"))
    of = stage(labelled.select(F.col("fp").alias("of"), "label").join(lows, "label")
               .select("of", "component_id"), "simhash_components")
    return docs.join(of, F.col("fp") == F.col("of")).select(
        "id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
