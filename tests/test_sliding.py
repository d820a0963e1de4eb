"""Sliding frames against plain lists, at several lengths."""

import math
import random
import statistics

import pytest

from tickerlake.functions import sliding
from tickerlake.functions.sliding import Frame

LENGTHS = [1, 2, 3, 20, 50, 500]


def close_to(a, b):
    return a is None and b is None or a is not None and b is not None and math.isclose(
        a, b, rel_tol=1e-9, abs_tol=1e-9)


def plain(values, n, behind, at):
    rows = values[max(0, at - behind - n + 1):max(0, at - behind + 1)]
    x = [a for a, _ in rows if a is not None]
    both = [(a, b) for a, b in rows if a is not None and b is not None]
    out = {
        "avg": sum(x) / len(x) if x else None, "mean": sum(x) / len(x) if x else None,
        "std": statistics.stdev(x) if len(x) > 1 else None,
        "max": max(x, default=None), "min": min(x, default=None), "covar": None, "corr": None}
    if len(both) > 1:
        mx, my = (statistics.fmean(c) for c in zip(*both))
        out["covar"] = sum((a - mx) * (b - my) for a, b in both) / (len(both) - 1)
        sx, sy = (statistics.stdev(c) for c in zip(*both))
        out["corr"] = out["covar"] / (sx * sy) if sx * sy else None
    return out


@pytest.mark.parametrize("behind", [0, 1])
def test_frames_of_any_length(spark, behind):
    rnd = random.Random(behind)
    some = lambda: None if rnd.random() < 0.15 else rnd.uniform(-5, 5)
    series = {
        "mixed": [(some(), some()) for _ in range(700)],
        "flat": [(2.1, 0.1)] * 60,
        "large": [(1e9 + k % 3, float(k)) for k in range(90)],
        "none": [(None, None)] * 5, "one": [(3.0, 4.0)],
    }
    rows = [(k, i, a, b) for k, v in series.items() for i, (a, b) in enumerate(v)]
    df = spark.createDataFrame(rows, "k string, i int, x double, y double").repartition(3)
    frames = []
    for n in LENGTHS:
        frames += [
            Frame("sum", ("x",), n, {f"avg_{n}": sliding.avg}, behind),
            Frame("moments", ("x",), n, {f"mean_{n}": sliding.mean, f"std_{n}": sliding.stddev}, behind),
            Frame("max", ("x",), n, {f"max_{n}": sliding.extreme}, behind),
            Frame("min", ("x",), n, {f"min_{n}": sliding.extreme}, behind),
            Frame("covar", ("x", "y"), n, {f"covar_{n}": sliding.covar}, behind),
            Frame("pair", ("x", "y"), n, {f"corr_{n}": sliding.corr}, behind),
        ]
    out = sliding.sliding(df, ["k"], ["i"], frames)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
    for r in out.collect():
        for n in LENGTHS:
            want = plain(series[r.k], n, behind, r.i)
            for name, value in want.items():
                if r.k == "large" and name in ("std", "covar", "corr"):
                    assert value is None or abs(r[f"{name}_{n}"] - value) < 1e-6 * max(1, abs(value))
                elif not (name == "corr" and r.k == "flat"):
                    assert close_to(r[f"{name}_{n}"], value), (r.k, r.i, n, name)
            if r.k == "flat":  # no spread, exactly
                assert r[f"std_{n}"] in (None, 0.0) and r[f"corr_{n}"] is None
