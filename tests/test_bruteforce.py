"""Price features against a plain-Python computation on random series."""

import math
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from test_frames import build, dkey


def _mean(xs):
    return sum(xs) / len(xs)


def _sd(xs):
    return statistics.stdev(xs) if len(xs) > 1 else None


def _cov(xs, ys):
    pairs = [(x, y) for x, y in zip(xs, ys) if x is not None and y is not None]
    if len(pairs) < 2:
        return None
    mx = _mean([p[0] for p in pairs])
    my = _mean([p[1] for p in pairs])
    return sum((x - mx) * (y - my) for x, y in pairs) / (len(pairs) - 1)


def expected(closes, opens, highs, lows, bench_returns):
    out = []
    for i, c in enumerate(closes):
        win = lambda n, xs=closes: xs[max(0, i - n + 1): i + 1]
        rets = [(closes[j] - opens[j]) / opens[j] for j in range(max(0, i - 19), i + 1)]
        gains = [max(closes[j] - closes[j - 1], 0.0) if j > 0 else 0.0 for j in range(max(0, i - 13), i + 1)]
        losses = [max(closes[j - 1] - closes[j], 0.0) if j > 0 else 0.0 for j in range(max(0, i - 13), i + 1)]
        ag, al = _mean(gains), _mean(losses)
        bench = bench_returns[max(0, i - 19): i + 1]
        var_b = statistics.variance(bench) if len(bench) > 1 else None
        cov = _cov(rets, bench)
        out.append({
            "ma_5": _mean(win(5)),
            "ma_20": _mean(win(20)),
            "ma_50": _mean(win(50)),
            "vol_20": _sd(rets),
            "rsi_14": 100.0 if al == 0 else 100 - 100 / (1 + ag / al),
            "drawdown": c / max(closes[: i + 1]) - 1,
            "cumulative_return": c / closes[0] - 1,
            "rolling_return_20": c / closes[i - 20] - 1 if i >= 20 else None,
            "resistance_level": max(highs[max(0, i - 19): i + 1]),
            "support_level": min(lows[max(0, i - 19): i + 1]),
            "beta_20": cov / var_b if cov is not None and var_b else None,
        })
    return out


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


prices = st.floats(min_value=1.0, max_value=500.0, allow_nan=False, allow_infinity=False)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    n=st.integers(min_value=1, max_value=45),
    data=st.data(),
)
def test_price_features_match_python(spark, n, data):
    rows, series = [], {}
    for sym in ("AAA", "SPY"):
        opens = data.draw(st.lists(prices, min_size=n, max_size=n))
        closes = data.draw(st.lists(prices, min_size=n, max_size=n))
        highs = [max(o, c) + 1 for o, c in zip(opens, closes)]
        lows = [min(o, c) - 0.5 for o, c in zip(opens, closes)]
        series[sym] = (closes, opens, highs, lows)
        rows += [(sym, i, opens[i], highs[i], lows[i], closes[i], 100) for i in range(n)]
    b = build(spark, stocks=rows)
    got = {(r.symbol, r.date_key): r.asDict() for r in b.daily_stock_analysis_wide().collect()}
    bench_c, bench_o = series["SPY"][0], series["SPY"][1]
    bench_ret = [(c - o) / o for c, o in zip(bench_c, bench_o)]
    for sym in ("AAA", "SPY"):
        want = expected(*series[sym], bench_ret)
        for i, w in enumerate(want):
            g = got[(sym, dkey(i))]
            for col, v in w.items():
                assert _close(g[col], v), (sym, i, col, g[col], v)
