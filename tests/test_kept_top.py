"""Top-k lists that follow loads, against lists of the whole table."""

import random

import pytest

from tickerlake.operators.kept_top import KeptTop
from tickerlake.operators.ledger import PART_COL, read_table
from tickerlake.operators.upsert import merge

SCHEMA = "symbol string, date_key int, n long"
KEY = ["symbol", "date_key"]
DAYS = [20240101, 20240102, 20240201]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(stored, k):
    out = []
    for day in {d for _, d in stored}:
        rows = [(s, d, n) for (s, d), n in stored.items() if d == day]
        rows.sort(key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        out += rows[:k]
    return sorted(out, key=str)


def listed(top):
    return sorted([(r.symbol, r.date_key, r.n) for r in top.lists().collect()], key=str)


def load(spark, top, table, stored, rows):
    stored.update({(s, d): n for s, d, n in rows})
    batch = frame(spark, rows)
    merge(spark, batch, table, KEY)
    return top.apply(batch, read_table(spark, table))


def test_random_loads(spark, tmp_dir):
    """New rows, raised, lowered and repeated ones, ties and nulls, a day with most rows."""
    rng, stored = random.Random(3), {}
    top, table = KeptTop(spark, f"{tmp_dir}/top", 4, [("n", True)], KEY), f"{tmp_dir}/table"
    for size in (25, 8, 8, 3):
        days = [DAYS[0]] * 4 + DAYS[1:]
        rows = {(f"s{rng.randrange(14)}", rng.choice(days)): rng.choice([None, 0, 1, 2, 3, 9])
                for _ in range(size)}
        load(spark, top, table, stored, [(*key, n) for key, n in rows.items()])
        assert listed(top) == brute(stored, 4)


def test_listed_row_is_replaced(spark, tmp_dir):
    stored = {}
    top, table = KeptTop(spark, f"{tmp_dir}/top", 2, [("n", True)], KEY), f"{tmp_dir}/table"
    day, other = DAYS[0], DAYS[2]
    load(spark, top, table, stored,
         [("a", day, 9), ("b", day, 8), ("c", day, 7), ("d", day, 6), ("a", other, 1)])
    # a better row and one that replaces the list's end by an equal one: nothing is listed anew
    assert load(spark, top, table, stored, [("e", day, 10), ("a", day, 9)]) == 0
    assert listed(top) == brute(stored, 2)
    # a listed row falls behind and nothing takes its place: that day is listed anew
    assert load(spark, top, table, stored, [("e", day, 0), ("b", other, 5)]) == 1
    assert listed(top) == brute(stored, 2) and ("b", day, 8) in listed(top)
    # one falls behind, and another row of the load takes its place ahead of the list's end
    assert load(spark, top, table, stored, [("a", day, None), ("f", day, 20), ("g", day, 8)]) == 0
    assert listed(top) == brute(stored, 2)
    before = listed(top)
    assert top.apply(frame(spark, [("f", day, 20)]), read_table(spark, table)) == 0  # a second time
    assert listed(top) == before
    assert top.apply(frame(spark, []), read_table(spark, table)) == 0
    assert listed(top) == before
    want = sorted(stored.items(), key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))[:2]
    assert [((r.symbol, r.date_key), r.n) for r in top.over_all().collect()] == want


def test_plans(spark, tmp_dir):
    """A rank limit before the shuffle; days listed anew read their months alone."""
    stored = {}
    top, table = KeptTop(spark, f"{tmp_dir}/top", 2, [("n", True)], KEY), f"{tmp_dir}/table"
    load(spark, top, table, stored, [("a", d, 1) for d in DAYS])
    plan = top.first(read_table(spark, table))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    days = spark.createDataFrame([(DAYS[2],)], "date_key int")
    plan = top.rebuild(read_table(spark, table), days)._jdf.queryExecution().executedPlan().toString()
    assert PART_COL in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_wrong_use(spark, tmp_dir):
    for k in (0, 1001):
        with pytest.raises(ValueError):
            KeptTop(spark, tmp_dir, k, [("n", True)], KEY)
    with pytest.raises(ValueError):
        KeptTop(spark, tmp_dir, 2, [("n", True)], ["symbol"])
    top = KeptTop(spark, f"{tmp_dir}/none", 2, [("n", True)], KEY)
    assert top.lists() is None and top.over_all() is None
    assert top.apply(frame(spark, []), frame(spark, [])) == 0 and top.lists() is None
