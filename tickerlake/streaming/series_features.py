"""Technical columns of a bar stream, kept up to date bar by bar.

State per stock: its last bars in event-time order (at most ``49 + reach``), and
of the bars that fell out of them their number, the first close and the largest
close.  A bar is placed by its day, whenever it comes; the rows from its day on
are computed anew and given out again, so the sink merges on (symbol, day) and
ends with the batch mart's rows.  A second bar of a day replaces the first (of
several in a micro-batch the one from the file written last, in a file the
last), one equal to the stored bar changes nothing.

Late-data rule: a bar is placed as long as the 49 bars before it are still
held, that is if fewer than ``reach`` bars of its stock are later, or if the
whole series is held.  An older bar is given out with ``late`` set and goes to
the late folder, from where ``plans.store.MarketStore.load`` or a batch build
takes it; it never changes the state.

A stock's state has no expiry (a series that pauses goes on where it was) and at
most ``(49 + reach) * 7`` values, about 8 KB at the usual reach.  The benchmark's
columns are not computed here: they join two series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.upsert import upsert
from ..plans.features import TECHNICAL_COLS
from ..sources.raw import LOAD_SEQ, STOCK_SCHEMA, raw_stocks, with_load_seq
from .daily_upsert import _start

#: Bars before a row that its longest frame reaches back to.
HALO = 49
#: Later bars of its stock that a late bar may have.
REACH = 100
BAR = ["date_key", "open_price", "high_price", "low_price", "close_price", "volume"]
BAR_DDL = ("date_key int, open_price double, high_price double, low_price double, "
           "close_price double, volume long")
PAST_DDL = "n long, first_close double, max_close double"
STREAM_COLS = [*TECHNICAL_COLS, "drawdown", "cumulative_return"]
OUT_DDL = ", ".join(
    f"{c} " + {"date_key": "int", "symbol": "string", "volume": "long"}.get(c, "double")
    for c in STREAM_COLS
) + ", late boolean"


def _frames(x: np.ndarray, n: int) -> np.ndarray:
    """The frame of ``n`` rows that ends at each row; NaN where there is none."""
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(n - 1, np.nan), x]), n)


def _mean(x: np.ndarray, n: int) -> np.ndarray:
    f = _frames(x, n)
    count = np.sum(~np.isnan(f), axis=1)
    return np.where(count > 0, np.nansum(f, axis=1) / np.maximum(count, 1), np.nan)


def _stddev(x: np.ndarray, n: int) -> np.ndarray:
    f = _frames(x, n)
    count = np.sum(~np.isnan(f), axis=1)
    squares = np.nansum((f - _mean(x, n)[:, None]) ** 2, axis=1)
    return np.where(count > 1, np.sqrt(squares / np.maximum(count - 1, 1)), np.nan)


def _divide(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.full(len(a), np.nan), where=(b != 0) & ~np.isnan(b))


def technical(symbol: str | None, bars: pd.DataFrame, past: tuple | None) -> pd.DataFrame:
    """``STREAM_COLS`` of consecutive bars; those after dropped bars (``past``) are
    right from position ``HALO`` on."""
    o, h, lo, c = (bars[k].to_numpy(dtype=float) for k in BAR[1:5])
    prev = np.concatenate([[np.nan], c[:-1]])
    step = c - prev
    out = pd.DataFrame({
        "date_key": bars["date_key"], "symbol": symbol, "open_price": o, "close_price": c, "high_price": h,
        "low_price": lo, "volume": bars["volume"], "daily_return": _divide(c - o, o),
        "price_range": h - lo, "prev_close": prev,
        "gain": np.where(step > 0, step, 0.0), "loss": np.where(step < 0, -step, 0.0),
    })
    for name, n in {"ma_5": 5, "ma_20": 20, "ma_50": 50, "ema_12": 12, "ema_26": 26}.items():
        out[name] = _mean(c, n)
    out["vol_20"] = _stddev(out["daily_return"].to_numpy(), 20)
    out["macd_line"] = out["ema_12"] - out["ema_26"]
    gain, loss = _mean(out["gain"].to_numpy(), 14), _mean(out["loss"].to_numpy(), 14)
    out["avg_gain"], out["avg_loss"] = gain, loss
    out["rsi_14"] = np.where(loss == 0, 100.0, 100 - 100 / (1 + _divide(gain, loss)))
    n, first, largest = past or (0, None, None)
    first = c[0] if n == 0 else np.nan if first is None else first
    peak = np.fmax.accumulate(np.concatenate([[np.nan if largest is None else largest], c]))[1:]
    out["drawdown"] = _divide(c, peak) - 1
    out["cumulative_return"] = _divide(c, np.full(len(c), first)) - 1
    return out[STREAM_COLS]


class LastBars(StatefulProcessor):
    """Places the bars of one stock and gives out what they change."""

    def __init__(self, reach: int = REACH):
        self.reach = reach

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bars = handle.getListState("bars", BAR_DDL)
        self.past = handle.getValueState("past", PAST_DDL)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = {r[0]: tuple(r) for r in self.bars.get()} if self.bars.exists() else {}
        past = tuple(self.past.get()) if self.past.exists() else None
        batch = pd.concat(list(rows)).sort_values(["written", "file", "place"])
        batch = batch.drop_duplicates("date_key", keep="last")
        batch = batch[BAR].astype(object).where(batch[BAR].notna(), None)
        # the first day whose 49 bars before it are held, or any if all are
        days = sorted(held)
        start = None if past is None else days[HALO]
        new, late = {}, []
        for r in batch.itertuples(index=False, name=None):
            if start is not None and r[0] < start:
                late.append(r)
            elif held.get(r[0]) != r:
                new[r[0]] = r
        if late:
            old = pd.DataFrame(late, columns=BAR).reindex(columns=STREAM_COLS)
            yield old.assign(symbol=key[0], late=True)
        if not new:
            return
        held |= new
        days = sorted(held)
        bars = pd.DataFrame([held[d] for d in days], columns=BAR)
        out = technical(key[0], bars, past)
        yield out[out["date_key"] >= min(new)].assign(late=False)
        gone = max(len(days) - HALO - self.reach, 0)
        if gone:
            closes = [held[d][4] for d in days[:gone]]
            n, first, largest = past or (0, closes[0], None)
            known = [c for c in (largest, *closes) if c is not None]
            self.past.update((n + gone, first, max(known) if known else None))
        self.bars.put([held[d] for d in days[gone:]])

    def close(self) -> None:
        pass


def series_features(bars: DataFrame, reach: int = REACH) -> DataFrame:
    """A stream of bars (feed columns and ``load_seq``) to rows of ``STREAM_COLS``
    and ``late``, in update mode.  Bars without symbol or day are left out, as in
    the fact."""
    if reach < 1:
        raise ValueError("a stock's last bar must be held: reach is 1 or more")
    keyed = bars.filter(F.col("symbol").isNotNull() & F.col("datetime").isNotNull()).select(
        "symbol",
        F.date_format("datetime", "yyyyMMdd").cast("int").alias("date_key"),
        *[F.col(c).alias(f"{c}_price") for c in ("open", "high", "low", "close")], "volume",
        *[F.col(f"{LOAD_SEQ}.{c}").alias(c) for c in ("written", "file", "place")],
    )
    return keyed.groupBy("symbol").transformWithStateInPandas(
        LastBars(reach), OUT_DDL, outputMode="Update", timeMode="None")


def technical_stream(
    spark: SparkSession,
    feed_dir: str,
    mart_path: str,
    late_path: str,
    checkpoint: str,
    available_now: bool = True,
    files_per_batch: int = 1000,
    reach: int = REACH,
) -> StreamingQuery:
    """Stream stock-bar files into a mart of technical columns, merged on (symbol,
    day); late bars go to ``late_path``, one folder per micro-batch, so a
    replayed one replaces its own.  The session's state store must be RocksDB
    (``ROCKSDB_CONF``), which keeps state on disk and its changes in the
    checkpoint folder."""
    stream = with_load_seq(
        spark.readStream.schema(STOCK_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(feed_dir))

    def handle(batch: DataFrame, epoch_id: int) -> None:
        # two reads of a stateful batch would run it twice: it is written once
        staged = f"{late_path.rstrip('/')}/_staged/{epoch_id}"
        batch.write.mode("overwrite").parquet(staged)
        rows = batch.sparkSession.read.schema(batch.schema).parquet(staged)
        late = rows.filter("late").select("date_key", "symbol")
        if not late.isEmpty():
            late.write.mode("overwrite").parquet(f"{late_path.rstrip('/')}/epoch={epoch_id}")
        upsert(batch.sparkSession, rows.filter("not late").drop("late"), mart_path,
               ["symbol", "date_key"], high_water=False)

    return _start(series_features(raw_stocks(stream), reach), handle, checkpoint, available_now, "update")


#: Setting of sessions that run :func:`technical_stream`.
ROCKSDB_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
