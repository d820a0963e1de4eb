"""Benchmark: the whole model graph on one input scale, one JSON line out.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPLICATE (default 1: replicate every symbol and its news N times, to
measure how the per-symbol work scales with the number of series), BENCH_COLD
(any value: also time every registered entry on a build of its own, feeds included).
Phases run in pipeline order on one build: feeds (RAW tables), warehouse
tables, then every registered query, each forced with a no-op write so all
of its work runs without collecting rows to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickerlake.plans.build import Build  # noqa: E402
from tickerlake.registry import QUERIES  # noqa: E402
from tickerlake.session import get_spark  # noqa: E402
from tickerlake.sources import fixtures  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(
        app="tickerlake-bench", cores=cpus, shuffle_partitions=max(8, 2 * cpus), driver_memory="16g"
    )
    copies = int(os.environ.get("BENCH_REPLICATE", "1"))
    feeds = None
    if copies > 1:
        feeds = fixtures.replicate_symbols(fixtures.load_sources(spark, sf_dir), copies)
    b = Build(spark, sf_dir, sources=feeds)
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    t_all = time.perf_counter()
    # RAW layer (derived feeds written as tables) and the warehouse tables.
    timed("feed_stocks", lambda: b.raw_stocks)
    timed("feed_news", lambda: b.raw_news)
    timed("feed_weather", lambda: b.raw_weather)
    for name in ("dim_stock", "dim_news", "dim_weather", "fact_stock", "bridge_daily_news",
                 "bridge_daily_weather", "index_series", "price_feature_table", "news_count_table",
                 "news_feature_table", "scored_table", "daily_bars"):
        timed(f"build_{name}", lambda n=name: getattr(b, n))
    # Every registered query, reading the stored tables.
    for q in QUERIES:
        timed(q.name, lambda q=q: run(q.build(b)))
    total = round(time.perf_counter() - t_all, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    cold: dict[str, float] = {}
    if os.environ.get("BENCH_COLD"):
        for q in QUERIES:
            t0 = time.perf_counter()
            run(q.build(Build(spark, sf_dir, sources=feeds)))
            cold[q.name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({
        "metric": "model_graph_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "replicate": copies,
    } | ({"cold": cold} if cold else {})))
    spark.stop()


if __name__ == "__main__":
    main()
