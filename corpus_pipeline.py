"""The corpus pipeline: toxicity, exact dedup, near-dedup, mixing, encoding.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; ``run`` writes
every stage's result and hands the reread table on.  All but the last return
the columns of their input.  A stage tells rows apart by a row number of its
own, so repeated ids and null ids are rows like any others, and extra columns
pass through: what a stage adds in between has reserved names that start with
``__corpus_pipeline``.  Null and empty texts are texts without words, very long
ones are read whole, and an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.llm import exact_dedup as exact
from tickerlake.llm import mixing, sentencepiece_bpe, simhash
from tickerlake.llm import toxicity as toxic
from tickerlake.llm.common import read_table, stage
from tickerlake.llm.vocabulary import piece_model

#: Names of what stages add in between; longer than any column they could meet.
ROW = "__corpus_pipeline_row_number"
OF = "__corpus_pipeline_row_number_of"
COPIES = "__corpus_pipeline_copies"
#: No SQL: model scores, SimHash components and token ids are not expressible.
ORACLE_SQL: str | None = None


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """The documents with a fixed row number, as a table in the shared folder."""
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), name)


def _one_of_each(numbered: DataFrame, groups: DataFrame) -> DataFrame:
    """Of every group (``id`` row number, ``label``) the row with the smallest doc_id."""
    ids = numbered.select(F.col(ROW).alias("row"), F.col("doc_id").alias("doc"))
    keep = (
        groups.join(ids, F.col("id") == F.col("row"))
        .groupBy("label")
        .agg(F.min(F.struct(F.col("doc").isNull().alias("last"), "doc", "row")).alias("k"))
        .select(F.col("k.row").alias(OF))
    )
    return numbered.join(keep, F.col(ROW) == F.col(OF), "left_semi").drop(ROW)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects (score 0.5 or more) go.

    The score depends on the text alone, so repeated rows and equal texts share
    their fate; null and empty texts score like texts without a toxic word.
    """
    model = toxic.train(docs, read_table(spark, sf_dir, "labels"))
    scored = toxic.score(docs, model, out_col=ROW)
    return scored.filter(F.col(ROW) < 0.5).drop(ROW)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays.

    A null id counts as the largest; of rows with one id and equal texts the first
    stays.  Null text equals the empty one.
    """
    rows = _numbered(docs, "pipeline_exact")
    groups = exact.exact_dedup(rows, id_col=ROW)
    return _one_of_each(rows, groups.select("id", F.col("keep_id").alias("label")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every SimHash component the document with the smallest id stays.

    Ties as in exact dedup.  Null and wordless texts have fingerprint zero and so
    are one component, like any other fingerprint's.
    """
    rows = _numbered(docs, "pipeline_near")
    groups = simhash.simhash_dedup(
        rows, id_col=ROW, shingle=simhash.SHINGLE, most_bits=simhash.MOST_BITS)
    return _one_of_each(rows, groups.select("id", F.col("component_id").alias("label")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it.

    Documents without words (null text too) have size 0 and are not repeated
    beyond their target; a null source is a source of its own, the last one.
    """
    rows = _numbered(docs, "pipeline_mix")
    taken = mixing.mix(rows, row_col=ROW).filter("copies > 0").select(
        F.col("row").alias(OF), F.col("copies").alias(COPIES))
    of = rows.columns
    return (
        rows.join(taken, F.col(ROW) == F.col(OF))
        .select(*[rows[c] for c in of if c != ROW],
                F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES))).alias(ROW))
        .drop(ROW)
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every taken document, and digests of ids and decoded text.

    One row per input row, repeated ones too; null text is encoded as empty.
    Other columns than the id are not carried on.
    """
    return sentencepiece_bpe.encode_decode(docs, piece_model()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, function) in enumerate(STAGES):
        docs = stage(function(spark, docs, sf_dir), f"pipeline_{k}")
    return docs
