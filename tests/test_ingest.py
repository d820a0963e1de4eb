"""Text feeds with drifting columns and bad records."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerlake.operators.upsert import one_per_key
from tickerlake.plans import warehouse
from tickerlake.sources import ingest
from tickerlake.sources.ingest import STOCKS, FeedSpec

GOOD = {"symbol": "A", "datetime": "2024-01-02", "open": 1.5, "high": 2.5, "low": 1.0, "close": 2.0, "volume": 7}


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def without(*names, **more):
    return {k: v for k, v in (GOOD | more).items() if k not in names}


def test_json_reasons(spark, tmp_dir):
    cases = [
        (GOOD, []),
        (without("symbol", "volume", ticker="B", vol=3), []),
        (without("symbol", ticker="B", day="x"), []),  # the declared column counts
        (without("datetime", date="05.01.2024"), []),
        (without(datetime="20240106"), []),
        (without("open", "high", "low", "volume"), []),
        (without(volume=None, currency="USD"), []),
        (without(datetime="2024-02-30"), ["bad datetime"]),
        (without(datetime="n/a", close="1,5"), ["bad datetime", "bad close"]),
        (without("symbol"), ["missing symbol"]),
        (without(symbol="  "), ["missing symbol"]),
        (without(volume="1.5"), ["bad volume"]),
        (without(volume="99999999999999999999"), ["bad volume"]),
        (without(close="NaN"), ["bad close"]),
        (without(close="-Infinity"), ["bad close"]),
        (without(volume=-1, high=0.5), ["rule volume", "rule range"]),
        (without(close=0), ["rule price"]),
    ]
    lines = [json.dumps(r) for r, _ in cases] + ["", "   "]
    broken = [json.dumps(GOOD)[:-1], "[1, 2]", "no json", '"text"']
    write(f"{tmp_dir}/feed", "a.json", lines + broken)
    rows = ingest.classify(ingest.records(spark, f"{tmp_dir}/feed"), STOCKS).orderBy("load_seq").collect()
    assert [r.reasons for r in rows] == [reasons for _, reasons in cases] + [["unreadable"]] * 4
    assert [r.record for r in rows][-4:] == broken
    assert (rows[1].symbol, rows[1].volume, str(rows[3].datetime), str(rows[4].datetime)) == (
        "B", 3, "2024-01-05", "2024-01-06")
    assert rows[6].extra_columns == {"currency": "USD"} and rows[0].extra_columns is None
    assert rows[8].symbol == "A" and rows[8].close is None  # what can be cast is


def test_csv_by_its_own_header(spark, tmp_dir):
    folder = f"{tmp_dir}/feed"
    write(folder, "a.csv", ["symbol,datetime,close,volume", "A,2024-01-02,2.0,1", 'B,2024-01-03,"3.0",2',
                            "C,2024-01-03,4.0,2,9", "D,2024-01-03"])
    write(folder, "b.csv", ["vol, close ,note,ticker,date", '5,6.0,"x, y",E,2024/01/04',
                            "vol, close ,note,ticker,date", "6,oops,,F,2024-01-05"])
    write(folder, "c.csv", ["﻿symbol,datetime,close", "G,2024-01-02,8"])
    write(folder, "d.csv", ["symbol,datetime,close"])
    got = {
        (r.symbol, r.volume, r.close, tuple(r.reasons), (r.extra_columns or {}).get("note"))
        for r in ingest.classify(ingest.records(spark, folder, "csv"), STOCKS).collect()
    }
    assert got == {
        ("A", 1, 2.0, (), None), ("B", 2, 3.0, (), None), (None, None, None, ("unreadable",), None),
        ("D", None, None, ("missing close",), None), ("E", 5, 6.0, (), "x, y"),
        ("F", 6, None, ("bad close",), None), ("G", None, 8.0, (), None),
    }


def test_loads_add_up_and_repeat(spark, tmp_dir):
    root, one, two = f"{tmp_dir}/store", f"{tmp_dir}/one", f"{tmp_dir}/two"
    assert ingest.accepted(spark, STOCKS, root).count() == 0
    write(one, "a.json", [json.dumps(GOOD), json.dumps(without("symbol")), "{"])
    write(two, "a.json", [json.dumps(without(close=9.0)), json.dumps(without(close=1.25)), json.dumps(without(open="x"))])
    ingest.load(spark, one, STOCKS, root, "1")
    for _ in range(2):  # a repeated load replaces its rows
        ingest.load(spark, two, STOCKS, root, "2")
    good, bad = ingest.accepted(spark, STOCKS, root), ingest.quarantined(spark, STOCKS, root)
    assert (good.count(), bad.count()) == (3, 3)
    counts = {(r.load_id, r.reason): r.records for r in ingest.reason_counts(spark, STOCKS, root).collect()}
    assert counts == {("1", "accepted"): 1, ("1", "missing symbol"): 1, ("1", "unreadable"): 1,
                      ("2", "accepted"): 2, ("2", "bad open"): 1}
    assert {(r.load_id, r.record == "{", os.path.basename(r.file)) for r in bad.collect()} == {
        ("1", False, "a.json"), ("1", True, "a.json"), ("2", False, "a.json")}
    # of the records of one key the last line of the file written last is loaded
    last = one_per_key(good.drop("extra_columns"), ["symbol", "datetime"], ["load_seq"]).collect()
    assert [r.close for r in last] == [1.25]
    dim = spark.createDataFrame([(1, "A")], "stock_key long, symbol string")
    assert warehouse.fact_stock(good, dim, ["load_seq"]).count() == 3


def test_empty_feed_and_column_report(spark, tmp_dir):
    write(f"{tmp_dir}/e", "a.json", [""])
    ingest.load(spark, f"{tmp_dir}/e", STOCKS, f"{tmp_dir}/es", "1")
    assert ingest.quarantined(spark, STOCKS, f"{tmp_dir}/es").count() == 0
    write(f"{tmp_dir}/f", "a.json", [json.dumps(GOOD), json.dumps(without("volume", vol=1, currency="X")), "{"])
    report = ingest.column_report(ingest.records(spark, f"{tmp_dir}/f"), STOCKS)
    got = {r.name: (r.meaning, r.records) for r in report.collect()}
    assert got["volume"] == ("volume", 1) and got["vol"] == ("volume", 1)
    assert got["currency"] == (None, 1) and got["close"] == ("close", 2)
    empty = ingest.column_report(ingest.records(spark, f"{tmp_dir}/e"), STOCKS)
    assert {r.records for r in empty.collect()} == {0}


def test_times_and_own_formats(spark, tmp_dir):
    spec = FeedSpec(
        T.StructType([T.StructField("at", T.TimestampType()), T.StructField("d", T.DateType())]),
        formats={"d": ("MM-dd-yyyy",)})
    write(f"{tmp_dir}/f", "a.json", [
        '{"at": "2024-01-02 03:04:05", "d": "01-31-2024"}', '{"at": "2024-01-02T03:04:05Z"}',
        '{"at": "2024-01-02", "d": "2024-01-31"}', '{"at": "later"}'])
    rows = ingest.classify(ingest.records(spark, f"{tmp_dir}/f"), spec).orderBy("load_seq").withColumn(
        "at", F.col("at").cast("string")).collect()
    assert [r["at"] for r in rows] == ["2024-01-02 03:04:05"] * 2 + ["2024-01-02 00:00:00", None]
    assert [r.reasons for r in rows] == [[], [], ["bad d"], ["bad at"]]
