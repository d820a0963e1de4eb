"""Intake of the stock feed as text: what is loaded and what is quarantined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from ..sources import ingest
from ..sources.fixtures import messy_stock_lines


def messy_store(build) -> str:
    """A store after one load of the messy text feed."""
    feed, root = (shared_path(build.spark, name) for name in ("messy_feed", "intake"))
    messy_stock_lines(build.raw_stocks).write.text(feed)
    ingest.load(build.spark, feed, ingest.STOCKS, root, "1")
    return root


def intake_stocks(build) -> DataFrame:
    """Every record of the messy feed: its values, those of unknown columns, and the
    reasons against it (none where it is accepted)."""
    root, cols = messy_store(build), ["symbol", "datetime", "open", "high", "low", "close", "volume"]
    good = ingest.accepted(build.spark, ingest.STOCKS, root).withColumn(
        "reasons", F.array().cast("array<string>"))
    bad = ingest.quarantined(build.spark, ingest.STOCKS, root)
    return good.select(*cols, "extra_columns", "reasons").unionByName(
        bad.select(*cols, "extra_columns", "reasons")
    ).select(*cols, F.col("extra_columns")["currency"].alias("currency"), "reasons")
