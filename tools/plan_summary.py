"""Summarise the physical plan of every registered query.

Usage: python tools/plan_summary.py [sf_dir] [--no-broadcast]
For each query: shuffle exchanges, single-partition exchanges, join
strategies, window and aggregate nodes of the executed plan.  With
``--no-broadcast`` automatic broadcast joins are disabled, which shows the
plans the optimizer picks once tables outgrow the broadcast threshold (the
explicit hints for fixed-size tables stay).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict[str, int]:
    plan = plan.split("== Initial Plan ==")[0]  # adaptive plans print both
    c = {}
    for label, pat in [
        ("shuffle", r"Exchange hashpartitioning|Exchange rangepartitioning"),
        ("single_partition", r"Exchange SinglePartition"),
        ("broadcast_join", r"BroadcastHashJoin"),
        ("sort_merge_join", r"SortMergeJoin"),
        ("window", r"\bWindow \["),
        ("hash_agg", r"HashAggregate\(keys"),
        ("sort_agg", r"SortAggregate\(key"),
        ("scan", r"FileScan parquet|Scan ExistingRDD"),
    ]:
        c[label] = len(re.findall(pat, plan))
    return c


def main() -> None:
    args = sys.argv[1:]
    sf_dir = next((a for a in args if a.startswith("/")), "/root/testdata/sf0.01")
    extra = {}
    if "--no-broadcast" in args:
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    from tickerlake.plans import features, marts, templates, warehouse
    from tickerlake.plans.build import Build
    from tickerlake.registry import QUERIES
    from tickerlake.session import get_spark
    from tickerlake.sources import fixtures

    spark = get_spark(extra=extra)
    b = Build(spark, sf_dir)
    cols = ["shuffle", "single_partition", "broadcast_join", "sort_merge_join", "window",
            "hash_agg", "sort_agg", "scan"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    # builds of the stored tables (what the registered queries then scan)
    stored = [
        ("build feed_stocks", lambda: fixtures.stock_api(spark, sf_dir)),
        ("build feed_news", lambda: fixtures.news_api(spark, sf_dir)),
        ("build feed_weather", lambda: fixtures.weather_api(spark, sf_dir)),
        ("build dim_stock", lambda: warehouse.dim_stock(b.raw_stocks)),
        ("build dim_news", lambda: warehouse.dim_news(b.raw_news)),
        ("build dim_weather", lambda: warehouse.dim_weather(b.raw_weather)),
        ("build fact_stock", lambda: warehouse.fact_stock(b.raw_stocks, b.dim_stock)),
        ("build index_series", lambda: features.index_series(b.stock_base)),
        ("build price_features", lambda: features.price_features(
            b.stock_base, b.index_series, largest=b.largest_stock_series)),
        ("build news_features", lambda: features.news_features(
            b.dim_news, b.stock_base, largest_stock=b.largest_stock_series,
            largest_news=b.largest_news_series, volume_z=b.price_feature_table,
            counts=b.news_count_table)),
        ("build scored", lambda: marts.scored(b.price_feature_table, b.news_feature_table)),
        ("build daily_bars", lambda: templates.daily_bars(b.raw_stocks, b.raw_news)),
        ("build daily_stocks", lambda: templates.daily_stocks(b.raw_stocks, b.raw_news)),
        ("build stock_news_daily", lambda: templates.stock_news_daily(b.daily_stocks, b.symbol_profile)),
        ("build weather_market_conditions", lambda: templates.weather_market_conditions(
            b.daily_weather, b.city_climate, b.daily_bars)),
    ]
    for name, make in stored + [(q.name, (lambda q=q: q.build(b))) for q in QUERIES]:
        df = make()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
