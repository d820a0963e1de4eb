"""Exact deduplication by Grace hashing.

Texts are equal when they are identical after every white-space run has become
one space.  The work is split until each piece fits a small table in memory:

1. Every task combines the equal texts it reads itself (an open-addressing
   table that compares complete content), so a text that a third of all rows
   share leaves a task as one record, not as a third of its rows.
2. The records are hashed to buckets, one shuffle partition each (the shuffle
   files are the spill files of the bucket).  A bucket fills a table of at most
   ``table_bytes`` of content; records whose content is not in a full table are
   spilled to a table in the shared folder.
3. The spilled records are partitioned again with another hash seed, until
   nothing spills.

Each level is written to the shared checkpoint folder, so a lost executor costs
a task and not the job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, binary, id_text, shuffle_partitions, stage, values

TABLE_BYTES = 64 << 20
#: Bucket size aimed at, under the table size so that an even bucket doesn't spill.
BUCKET_BYTES = 32 << 20
#: Most buckets of one level; more data is split by the next level's hash.
MOST_BUCKETS = 20_000
#: Rows a task combines before it hands its records on.
COMBINE_ROWS = 200_000
MOST_LEVELS = 40

_SPACES = frozenset(b" \t\n\r\x0b\x0c")


def normalise(text: bytes) -> bytes:
    """Every run of white space as one space (``bytes.split`` knows the same six)."""
    if not text:
        return text
    core = b" ".join(text.split())
    if not core:
        return b" "
    return (
        (b" " if text[0] in _SPACES else b"") + core + (b" " if text[-1] in _SPACES else b"")
    )


class ContentTable:
    """Open-addressing table from complete content to an entry number."""

    def __init__(self, slots: int = 1024):
        self.slots = [-1] * slots
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, content: bytes, hashed: int) -> int:
        """Entry of this content, or -1 - (the free slot where it belongs)."""
        mask = len(self.slots) - 1
        at = hashed & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == hashed and self.contents[entry] == content:
                return entry
            at = (at + 1) & mask
        return -1 - at

    def add(self, content: bytes, hashed: int, found: int) -> int:
        """Enter a content that ``find`` did not have; ``found`` is its answer."""
        entry = len(self.contents)
        self.slots[-1 - found] = entry
        self.hashes.append(hashed)
        self.contents.append(content)
        self.bytes += len(content) + 100
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, hashed in enumerate(self.hashes):
            at = hashed & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


_COMBINED = pa.schema([
    ("uid", pa.int64()), ("id", pa.int64()), ("first", pa.bool_()), ("n", pa.int64()),
    ("n_bytes", pa.int64()), ("content", pa.binary()),
])
_COMBINED_DDL = "uid long, id long, first boolean, n long, n_bytes long, content binary"

_LEVEL = pa.schema([
    ("uid", pa.int64()), ("keep_uid", pa.int64()), ("keep_id", pa.int64()),
    ("group_size", pa.int64()), ("sha256", pa.string()),
    ("id", pa.int64()), ("n", pa.int64()), ("n_bytes", pa.int64()), ("content", pa.binary()),
])
_LEVEL_DDL = (
    "uid long, keep_uid long, keep_id long, group_size long, sha256 string, "
    "id long, n long, n_bytes long, content binary"
)


def _order(doc_id: int | None) -> tuple:
    return (doc_id is None, doc_id or 0)


def _combine(table_bytes: int, combine_rows: int):
    """Task side of step 1: one record for each text and task; its content is on
    the row of the smallest id, the other rows name the record (``uid``)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 36
        done = 0

        def flush(table: ContentTable, ids: list[list]) -> Iterator[tuple]:
            nonlocal done
            for content, members in zip(table.contents, ids):
                uid, done = base + done, done + 1
                low = min(range(len(members)), key=lambda k: _order(members[k]))
                for k, doc_id in enumerate(members):
                    if k == low:
                        yield uid, doc_id, True, len(members), len(content), content
                    else:
                        yield uid, doc_id, False, None, None, None

        def rows() -> Iterator[tuple]:
            table, ids, held = ContentTable(), [], 0
            for batch in parts:
                for doc_id, text in zip(values(batch, "id"), binary(batch, "text")):
                    content = normalise(text)
                    hashed = xxhash.xxh64_intdigest(content)
                    entry = table.find(content, hashed)
                    if entry < 0:
                        table.add(content, hashed, entry)
                        ids.append([doc_id])
                    else:
                        ids[entry].append(doc_id)
                    held += 1
                    if table.bytes >= table_bytes or held >= combine_rows:
                        yield from flush(table, ids)
                        table, ids, held = ContentTable(), [], 0
            yield from flush(table, ids)

        yield from batches(rows(), _COMBINED, most_rows=5_000)

    return run


def _resolve(table_bytes: int):
    """Task side of steps 2 and 3: one bucket through one table."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            table = ContentTable()
            uids: list[list[int]] = []
            best: list[tuple] = []
            total: list[int] = []
            for batch in parts:
                for uid, doc_id, n, n_bytes, content in zip(
                    values(batch, "uid"), values(batch, "id"), values(batch, "n"),
                    values(batch, "n_bytes"), binary(batch, "content"),
                ):
                    hashed = xxhash.xxh64_intdigest(content)
                    entry = table.find(content, hashed)
                    mine = (*_order(doc_id), uid, doc_id)
                    if entry >= 0:
                        uids[entry].append(uid)
                        best[entry] = min(best[entry], mine, key=lambda x: x[:3])
                        total[entry] += n
                    elif table.bytes < table_bytes:
                        table.add(content, hashed, entry)
                        uids.append([uid])
                        best.append(mine)
                        total.append(n)
                    else:  # a full table takes no new content, so all copies spill together
                        yield uid, None, None, None, None, doc_id, n, n_bytes, content
            for entry, content in enumerate(table.contents):
                digest = hashlib.sha256(content).hexdigest()
                _, _, keep_uid, keep_id = best[entry]
                for uid in uids[entry]:
                    yield uid, keep_uid, keep_id, total[entry], digest, None, None, None, None

        yield from batches(rows(), _LEVEL)

    return run


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    table_bytes: int = TABLE_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    most_buckets: int = MOST_BUCKETS,
    combine_rows: int = COMBINE_ROWS,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    ``keep_id`` is the smallest id among the rows with an equal text,
    ``group_size`` their number, ``kept`` true on exactly one of them.  Null
    text counts as empty.  Null ids sort after all others: ``keep_id`` is null
    only where every row of the text has a null id.  Rows that repeat an id and
    its text count as rows of one group, of which one is kept.  Only the two
    named columns are read, so other columns may have any name; an empty table
    gives no rows.
    """
    spark = df.sparkSession
    pairs = id_text(df, id_col, text_col)
    combined = stage(
        pairs.mapInArrow(_combine(table_bytes, combine_rows), _COMBINED_DDL), "dedup_combined"
    )
    todo = combined.filter("n is not null").select("uid", "id", "n", "n_bytes", "content")
    levels: list[DataFrame] = []
    # A spilled record always meets fewer others at the next level; the level
    # limit only stops a table too small for even one content.
    for level in range(MOST_LEVELS):
        size = todo.agg(F.sum("n_bytes")).first()[0]
        if size is None and level:
            break
        n = max(shuffle_partitions(spark), -(-(size or 0) // bucket_bytes))
        done = stage(
            todo.repartition(min(n, most_buckets), F.xxhash64(F.lit(level), "content"))
            .mapInArrow(_resolve(table_bytes), _LEVEL_DDL),
            f"dedup_level{level}",
        )
        levels.append(done.filter("keep_uid is not null")
                      .select("uid", "keep_uid", "keep_id", "group_size", "sha256"))
        todo = done.filter("n is not null").select("uid", "id", "n", "n_bytes", "content")
    else:
        raise ValueError("table_bytes is too small: records still spill after the last level")
    resolved = levels[0]
    for more in levels[1:]:
        resolved = resolved.unionByName(more)
    return combined.select("uid", "id", "first").join(resolved, "uid").select(
        F.col("id"),
        F.col("keep_id"),
        F.col("group_size"),
        (F.col("first") & (F.col("uid") == F.col("keep_uid"))).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )
