"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

#: One or more of the six white-space characters that separate words, and a word.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage like a checkpoint (a lost executor re-reads files, it does
    not recompute), keeps the rows fixed for every later reader, and lets later
    readers prune columns.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def smallest(df: DataFrame, key: Column, order: list[str], n: int) -> DataFrame:
    """The ``n`` rows with the smallest ``key``, a hash that is even over all 64-bit
    values; ties by ``order``.

    One task orders them, so rows beyond a value that leaves a few more than
    ``n`` are left out before: what that task gets doesn't grow with the table.
    """
    total, share, name = df.count(), 0.0, "__smallest_key"
    keyed = df.withColumn(name, key)
    while True:
        share = min(1.0, max(2 * share, (n + 8 * n ** 0.5 + 64) / max(total, 1)))
        few = keyed if share == 1 else keyed.filter(
            F.col(name) < F.lit(int((share - 0.5) * 2.0 ** 64)))
        if share == 1 or few.count() >= n:
            return few.orderBy(name, *order).limit(n).drop(name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names: ``id`` long and
    ``text`` string with null as the empty text.  Whatever other columns the
    input has, whatever their names, stay behind."""
    return df.select(
        df[id_col].cast("long").alias("id"),
        F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text"),
    )


def n_words(text: Column) -> Column:
    """Number of words of a text (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def binary(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string or binary column as UTF-8 bytes, without decoding."""
    col = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return (col if pa.types.is_binary(col.type) else col.cast(kind)).to_pylist()


def values(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def batches(
    rows: Iterator[tuple], schema: pa.Schema, most_rows: int = 20_000, most_bytes: int = 16 << 20
) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches that stay under a row count and about a byte count."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) * (8 if isinstance(v, list) else 1)
                    for v in row if isinstance(v, (bytes, str, list)))
        if len(held) >= most_rows or size >= most_bytes:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema
    )
