"""Technical columns of a bar stream against the batch mart."""

import glob
import os
import random

import numpy as np
import pytest

from test_frames import bars, dkey
from tickerlake.operators.ledger import read_table
from tickerlake.plans import features, warehouse
from tickerlake.streaming.series_features import HALO, ROCKSDB_CONF, STREAM_COLS, technical_stream


@pytest.fixture()
def rocksdb(spark):
    for k, v in ROCKSDB_CONF.items():
        spark.conf.set(k, v)
    yield
    for k in ROCKSDB_CONF:
        spark.conf.unset(k)


def feed(seed, symbols, days):
    rng = random.Random(seed)
    rows = {}
    for s in symbols:
        price = 100.0
        for d in range(days):
            if rng.random() < 0.1:
                continue  # no bar on this day
            o, price = price, max(price + rng.uniform(-3, 3), 1.0)
            close = None if rng.random() < 0.02 else price
            rows[s, d] = (s, d, 0.0 if rng.random() < 0.02 else o, max(o, price) + 1, min(o, price) - 0.5, close,
                          rng.randrange(1000))
    return rows


def batch_mart(spark, rows):
    raw = bars(spark, rows)
    dim = warehouse.dim_stock(raw)
    base = features.stock_base(warehouse.fact_stock(raw, dim), dim)
    return features.price_features(base, features.index_series(base)).select(*STREAM_COLS)


def table(df):
    return {(r.symbol, r.date_key): tuple(r) for r in df.select(*STREAM_COLS).collect()}


def same(got, want):
    assert set(got) == set(want)
    for key, row in want.items():
        for name, a, b in zip(STREAM_COLS, got[key], row):
            if isinstance(b, float):
                assert a is not None and np.isclose(a, b, rtol=1e-9, atol=1e-9), (key, name, a, b)
            else:
                assert a == b, (key, name, a, b)


class Feed:
    """Files written in a given order."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0

    def add(self, rows):
        self.n += 1
        part = f"{self.folder}/part={self.n}"
        bars(self.spark, rows).coalesce(1).write.parquet(part)
        for f in glob.glob(f"{part}/*.parquet"):
            os.utime(f, (1_700_000_000 + self.n * 60,) * 2)


def run(spark, tmp_dir, reach):
    q = technical_stream(spark, f"{tmp_dir}/feed", f"{tmp_dir}/mart", f"{tmp_dir}/late", f"{tmp_dir}/check",
                         files_per_batch=1, reach=reach)
    q.awaitTermination()
    return read_table(spark, f"{tmp_dir}/mart")


def test_replay_with_a_late_file(spark, tmp_dir, rocksdb):
    """Files of days, one of them late and one of corrections, over two runs of the
    stream, end with the batch mart's rows."""
    rows = feed(1, ["A", "B", "SPY"], 150)
    wrong = {k: (*r[:5], 50.0, r[6]) for k, r in rows.items() if k[0] == "B" and k[1] in (118, 121)}
    files = Feed(spark, f"{tmp_dir}/feed")

    def days(a, b, of=rows):
        return [of[k] for k in sorted(of) if a <= k[1] < b]

    files.add(days(0, 90, rows | wrong))
    files.add(days(90, 100))
    files.add(days(110, 125, rows | wrong))  # 100 to 109 are late
    files.add(days(100, 110))
    run(spark, tmp_dir, reach=40)
    files.add(days(125, 140))
    files.add([rows[k] for k in wrong] + days(139, 150))
    mart = run(spark, tmp_dir, reach=40)
    same(table(mart), table(batch_mart(spark, list(rows.values()))))
    assert glob.glob(f"{tmp_dir}/late/epoch=*") == []


def test_too_late_bars_change_nothing(spark, tmp_dir, rocksdb):
    rows = {k: r for k, r in feed(2, ["A"], 100).items()}
    late = sorted(rows)[10]
    files = Feed(spark, f"{tmp_dir}/feed")
    files.add([r for k, r in rows.items() if k != late])
    files.add([rows[late]])
    mart = run(spark, tmp_dir, reach=5)
    same(table(mart), table(batch_mart(spark, [r for k, r in rows.items() if k != late])))
    got = spark.read.parquet(*glob.glob(f"{tmp_dir}/late/epoch=*")).collect()
    assert [(r.symbol, r.date_key) for r in got] == [("A", dkey(late[1]))]
    # the state holds no more bars than its bound
    state = spark.read.format("statestore").option("path", f"{tmp_dir}/check").option(
        "stateVarName", "bars").load()
    assert state.count() == HALO + 5
