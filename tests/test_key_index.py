"""Key indexes and the checks that follow loads."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickerlake.operators import key_index, ledger, quality
from tickerlake.plans import checks

SCHEMA = "id long, name string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def failing(index):
    return {tuple(r)[:-1]: r[-1] for r in index.failing().collect()}


@pytest.mark.parametrize("nulls", [False, True])
def test_uniqueness_follows_loads(spark, tmp_dir, nulls):
    """Random loads with repeated keys, nulls and a key that a third of the rows have."""
    rng = random.Random(5)
    index = key_index.KeyIndex(spark, f"{tmp_dir}/k", ["id", "name"], nulls=nulls, slots=5)
    assert index.failing() is None and index.failures().first()[0] == 0
    seen = Counter()
    for k in range(3):
        rows = [(rng.choice([None, 1, 2, rng.randrange(60)]), rng.choice(["", "a", "b", None]))
                for _ in range(40)] + [(7, "hot")] * 20
        index.add(f"load-{k}", frame(spark, rows))
        seen.update(r for r in rows if nulls or None not in r)
        want = {r: n for r, n in seen.items() if n > 1}
        assert failing(index) == want
        assert index.failures().first()["failures"] == len(want)
    assert index.keys().count() == len(seen)


def test_load_counts_once_and_empty_loads(spark, tmp_dir):
    index = key_index.KeyIndex(spark, f"{tmp_dir}/k", ["id"])
    assert index.add("none", frame(spark, [])) == []
    assert index.failures().first()["failures"] == 0
    rows = frame(spark, [(1, "x"), (2, "y")])
    assert index.add("a", rows) and index.add("a", rows) == []
    assert failing(index) == {}
    index.add("b", frame(spark, [(2, "other")]))
    assert failing(index) == {(2,): 2}
    index.add("take-back", frame(spark, [(2, "y")]), sign=-1)
    assert failing(index) == {}
    assert index.add("none", rows) == []  # an empty load's name is taken, too


def test_broken_load_is_finished(spark, tmp_dir, monkeypatch):
    """A load that stops between two slots is finished by the next touch, and counted once;
    one that stops before its record changes nothing and can be sent again."""
    index = key_index.KeyIndex(spark, f"{tmp_dir}/k", ["id"], slots=4)
    rows = frame(spark, [(i, "x") for i in range(40)])
    index.add("a", rows)
    move, moves = ledger.Files.move, []

    def breaks(self, source, target):
        if key_index.SLOT in target.rsplit("/", 1)[-1]:
            moves.append(target)
            if len(moves) == 2:
                raise OSError("lost")
        move(self, source, target)

    monkeypatch.setattr(ledger.Files, "move", breaks)
    with pytest.raises(OSError):
        index.add("b", rows)
    monkeypatch.setattr(ledger.Files, "move", move)
    assert index.add("b", rows) == []
    assert failing(index) == {(i,): 2 for i in range(40)}

    def no_record(*a, **k):
        raise OSError("lost")

    monkeypatch.setattr(key_index, "switch", no_record)
    with pytest.raises(OSError):
        index.add("c", rows)
    monkeypatch.undo()
    assert failing(index) == {(i,): 2 for i in range(40)}
    index.add("c", rows)
    assert failing(index) == {(i,): 3 for i in range(40)}


def test_relationship_heals(spark, tmp_dir):
    """Children before their parents, null children, a hot child, repeated parents."""
    index = key_index.KeyIndex(spark, f"{tmp_dir}/k", ["name"], key_index.RELATIONSHIP)
    children = frame(spark, [(1, "a"), (2, "a"), (3, "b"), (4, None)] + [(9, "c")] * 30)
    index.add("1", children, counter=key_index.CHILDREN)
    assert index.failures().first()["failures"] == 33
    parents = spark.createDataFrame([("a",), ("a",), (None,)], "symbol string")
    index.add("2", parents, ["symbol"], key_index.PARENTS)
    assert index.failures().first()["failures"] == 31
    index.add("3", spark.createDataFrame([("c",), ("z",)], "symbol string"), ["symbol"], key_index.PARENTS)
    assert index.failures().first()["failures"] == 1
    index.add("4", frame(spark, [(1, "z"), (2, "y")]), counter=key_index.CHILDREN)
    assert index.failures().first()["failures"] == 2


def test_only_touched_slots_are_read(spark, tmp_dir):
    index = key_index.KeyIndex(spark, f"{tmp_dir}/k", ["id"], slots=16)
    index.add("a", frame(spark, [(i, "x") for i in range(300)]))
    replaced = index.add("b", frame(spark, [(5, "x"), (6, "x")]))
    assert 1 <= len(replaced) <= 2
    new = spark.createDataFrame([(s,) for s in replaced], f"{key_index.SLOT} int")
    plan = index.touched(index.keys(), new)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and key_index.SLOT in plan.split("PartitionFilters: ")[1]
    read = index.touched(index.keys(), new).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split(f"{key_index.SLOT}=")[1].split("/")[0] for r in read} == {str(s) for s in replaced}
    pushed = index.failing()._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThan({key_index.ROWS},1)" in pushed
    assert failing(index) == {(5,): 2, (6,): 2}


def test_wrong_use(spark, tmp_dir):
    index = key_index.KeyIndex(spark, f"{tmp_dir}/k", ["id"])
    for load in ("", "../x", "a/b", ".hidden"):
        with pytest.raises(ValueError):
            index.add(load, frame(spark, []))
    with pytest.raises(ValueError):
        index.add("a", frame(spark, []), counter="n_parents")
    with pytest.raises(ValueError):
        key_index.KeyIndex(spark, f"{tmp_dir}/k", ["id"], slots=3)
    with pytest.raises(ValueError):
        key_index.KeyIndex(spark, f"{tmp_dir}/other", ["N_rows"])


def test_check_store_equals_whole_feed(spark, tmp_dir):
    """Planted faults in three loads, the second sent twice: the report of the whole table."""
    schema = "id long, related string, price double, datetime date"
    day = dt.date(2024, 1, 1)
    loads = [[(1, "A", 1.0, day), (2, "B", -1.0, day), (None, "Z", None, day)],
             [(2, "A", 0.0, None), (3, None, 2.0, day), (2, "B", 5.0, day)], [(1, "Y", 1.0, day)], []]
    links = [("news", "related", "stocks", "symbol")]
    declared = [quality.Check("news", c, k) for c, k in
                [("id", "not_null"), ("id", "unique"), ("price", "positive"), ("datetime", "not_null")]]
    store = checks.CheckStore(spark, f"{tmp_dir}/s", declared, [("news", ["id", "related"])], links)
    assert {r.failures for r in store.report().collect()} == {0}  # before any load
    stocks = spark.createDataFrame([("A",), ("B",), ("Y",)], "symbol string")
    for k in (0, 1, 1, 2, 3):
        store.load(f"l{k}", "news", spark.createDataFrame(loads[k], schema))
        if k == 1:
            store.load("l1", "stocks", stocks)
    whole = spark.createDataFrame([r for rows in loads for r in rows], schema)
    want = quality.check_table(whole, declared).unionByName(
        quality.grain_report([("news", whole, ["id", "related"])])).unionByName(
        quality.relationship_report([("news", whole, "related", stocks, "symbol")]))
    assert sorted(map(tuple, store.report().collect())) == sorted(map(tuple, want.collect()))
    assert sorted(r.failures for r in want.collect()) == [1, 1, 1, 1, 2, 2]
