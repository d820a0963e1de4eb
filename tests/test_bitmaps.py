"""Exact distinct counts from bitmaps."""

import random

from tickerlake.operators import bitmaps
from tickerlake.operators.ledger import read_table


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "date_key int, stock_key long")


def counts(states):
    return {(r.span, r.start_key): r.n for r in bitmaps.counts_by_span(states, "n").collect()}


def brute(pairs):
    sets = {}
    for day, key in pairs:
        if key is not None:
            for span in (("day", day), ("month", day // 100 * 100 + 1), ("year", day // 10000 * 10000 + 101)):
                sets.setdefault(span, set()).add(key)
    return {span: len(keys) for span, keys in sets.items()}


def test_counts_over_buckets_and_spans(spark):
    """Keys on both sides of the bucket limits, repeated rows, null keys, key 0."""
    rng = random.Random(1)
    keys = [0, 1, 2, 32_767, 32_768, 32_769, 65_536, 65_537, 1_000_000, 5_000_000_000, None]
    days = [20231231, 20240101, 20240102, 20240201]
    pairs = [(rng.choice(days), rng.choice(keys)) for _ in range(60)] + [(20250301, None)]
    states = bitmaps.key_bitmaps(rows(spark, pairs), ["date_key"], "stock_key")
    assert counts(states) == brute(pairs)
    assert counts(bitmaps.key_bitmaps(rows(spark, []), ["date_key"], "stock_key")) == {}


def test_loads_add_up(spark, tmp_dir):
    """Loads that overlap, one of them twice, one empty; other months stay as they are."""
    path = f"{tmp_dir}/tracked"
    one = [(20240101, 1), (20240101, 2), (20240201, 1)]
    two = [(20240101, 2), (20240101, 40_000), (20240102, 3)]
    assert bitmaps.add_days(spark, rows(spark, []), path, "stock_key") == []
    assert read_table(spark, path) is None
    assert sorted(bitmaps.add_days(spark, rows(spark, one), path, "stock_key")) == [202401, 202402]
    for _ in range(2):
        assert bitmaps.add_days(spark, rows(spark, two), path, "stock_key") == [202401]
    assert bitmaps.add_days(spark, rows(spark, []), path, "stock_key") == []
    assert counts(read_table(spark, path)) == brute(one + two)


def test_plan_expands_nothing(spark):
    states = bitmaps.key_bitmaps(rows(spark, [(20240101, 1)]), ["date_key"], "stock_key")
    plan = bitmaps.counts_by_span(states, "n")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
