"""Daily feed files as a stream: each micro-batch is one incremental load.

The warehouse's incremental models are re-aimed at Structured Streaming: a
file source picks up new feed files, and ``foreachBatch`` merges each on the unique
key with stable stock keys.  A micro-batch sees some files and not the whole
feed, so no high-water mark is applied: a second file of a stored day is
merged.  Of records with one key in a micro-batch the one from the file written
last is loaded, in a file the last one; a micro-batch without rows changes nothing.  A micro-batch replayed after a failure merges the same rows again and
so repairs what it had left; progress lives in the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import stable_stock_keys, upsert
from ..plans import warehouse
from ..sources.raw import (
    LOAD_SEQ, STOCK_SCHEMA, WEATHER_FEED_SCHEMA, raw_stocks, raw_weather, with_load_seq,
)


def _start(stream: DataFrame, handle, checkpoint: str, available_now: bool,
           mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).outputMode(mode).option(
        "checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute"
    )
    return writer.start()


def stock_fact_stream(
    spark: SparkSession,
    feed_dir: str,
    dim_path: str,
    fact_path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Stream stock-bar files into DIM_STOCK (stable keys) and FACT_STOCK."""
    stream = with_load_seq(spark.readStream.schema(STOCK_SCHEMA).parquet(feed_dir))

    def handle(batch: DataFrame, epoch_id: int) -> None:
        bars = raw_stocks(batch)
        dim = stable_stock_keys(spark, bars, dim_path)
        upsert(spark, warehouse.fact_stock(bars, dim, [LOAD_SEQ]), fact_path,
               ["stock_key", "date_key"], high_water=False, load_order=[LOAD_SEQ])

    return _start(stream, handle, checkpoint, available_now)


def weather_dim_stream(
    spark: SparkSession,
    feed_dir: str,
    dim_path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Stream weather files into DIM_WEATHER keyed by (city, date_key)."""
    stream = with_load_seq(spark.readStream.schema(WEATHER_FEED_SCHEMA).parquet(feed_dir))

    def handle(batch: DataFrame, epoch_id: int) -> None:
        upsert(spark, warehouse.dim_weather(raw_weather(batch), [LOAD_SEQ]), dim_path,
               ["city", "date_key"], high_water=False, load_order=[LOAD_SEQ])

    return _start(stream, handle, checkpoint, available_now)
