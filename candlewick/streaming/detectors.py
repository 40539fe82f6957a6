"""Streaming form of the three detectors: one stateful processor per symbol.

``groupBy('symbol').transformWithStateInPandas(...)`` with ``timeMode
'None'`` and no watermark: detectors see every trade, late ones included,
as the reference's keyed process functions do. Rows of a micro-batch are
sorted by ``(trade_time_ms, trade_id)``; between batches arrival order rules.

State per symbol (all bounded):

* wash: the ``wash_frame - 1`` last prices and quantities (ListState);
* spike: the ``spike_frame - 1`` last recent-counts, trades per millisecond of
  the last ``spike_window_ms`` (ListState) and the last alert time (ValueState);
* pump: baseline price and time, peak since (ValueState).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from candlewick.functions.exprs import ms_to_ts
from candlewick.operators.detect import ANOMALY_COLUMNS, cooled, pump_rule
from candlewick.params import DEFAULT, SPIKE_TEXT, WASH_TEXT, Params
from candlewick.session import ship_package

ALERT_SCHEMA = (
    "symbol string, trade_id long, trade_time_ms long, pattern_type string, severity string, "
    "price_start double, price_end double, price_change_pct double, volume_ratio double, description string"
)
_OUT_COLS = [f.strip().split(" ")[0] for f in ALERT_SCHEMA.split(",")]


class Trailing:
    """The last ``frame`` values up to each of ``new``, continued from
    ``before`` (the values ahead of them, oldest first)."""

    def __init__(self, before: np.ndarray, new: np.ndarray, frame: int):
        self.frame, self.n = frame, len(new)
        self.known = before[max(0, len(before) - frame + 1) :]
        self.values = np.concatenate([self.known, new])
        #: how many values each frame holds
        self.length = np.minimum(len(self.known) + np.arange(1, self.n + 1), frame)

    def fold(self, op: np.ufunc, start) -> np.ndarray:
        """``op`` over every frame, oldest value first, so sums round as a
        window aggregate's do: one array operation per place in the frame."""
        padded = np.concatenate([np.full(self.frame - 1 - len(self.known), start, self.values.dtype), self.values])
        out = np.full(self.n, start, self.values.dtype)
        for k in range(self.frame):
            out = op(out, padded[k : k + self.n])
        return out

    def tail(self) -> list:
        """What the next batch continues from."""
        return self.values[max(0, len(self.values) - self.frame + 1) :].tolist()


def ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a / b, 0 where b is not positive."""
    return np.divide(a, b, out=np.zeros(len(b)), where=b > 0)


class RecentCounts:
    """How many trades of the last ``window`` ms were seen, as counts per
    millisecond (``at`` rising), so a burst does not grow the state."""

    def __init__(self, at: np.ndarray, n: np.ndarray, window: int):
        self.at, self.n, self.window = at, n, window

    def add(self, ts: np.ndarray) -> np.ndarray:
        """Counts at each of ``ts`` (rising), itself included."""
        first = ts - self.window
        ahead = np.concatenate([[0], np.cumsum(self.n)])
        carried = ahead[-1] - ahead[np.searchsorted(self.at, first)]
        own = np.arange(1, len(ts) + 1) - np.searchsorted(ts, first)
        at, back = np.unique(np.concatenate([self.at, ts]), return_inverse=True)
        n = np.bincount(back, np.concatenate([self.n, np.ones(len(ts))])).astype(np.int64)
        fresh = at >= first[-1]
        self.at, self.n = at[fresh], n[fresh]
        return carried + own


def _columns(state, types: tuple) -> list[np.ndarray]:
    """A list state as one array per field."""
    rows = list(state.get()) if state.exists() else []
    return [np.array([r[i] for r in rows], kind) for i, kind in enumerate(types)]


class DetectorProcessor(StatefulProcessor):
    """WASH_TRADE, VOLUME_SPIKE and PUMP_AND_DUMP for one symbol's stream.

    Each micro-batch is evaluated as arrays behind the values carried in the
    state; Python runs per alert (and per pump baseline), not per trade."""

    def __init__(self, p: Params = DEFAULT):
        self.p = p
        self.pump = pump_rule(p)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.wash = handle.getListState("wash", "price double, quantity double")
        self.counts = handle.getListState("spike_counts", "n long")
        self.recent = handle.getListState("spike_recent", "ts long, n long")
        self.last_alert = handle.getValueState("spike_last_alert", "ts long")
        self.pump_state = handle.getValueState("pump", "base_price double, base_ms long, peak_price double, expired boolean")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Start a symbol from a saved state (``operators.resume``)."""
        row, p = initialState.iloc[0], self.p
        tail = list(row["tail"])
        wash, counts = tail[max(0, len(tail) - p.wash_frame + 1) :], tail[max(0, len(tail) - p.spike_frame + 1) :]
        self.wash.put([(float(t["price"]), float(t["quantity"])) for t in wash])
        self.counts.put([(int(t["recent_count"]),) for t in counts])
        # the tail's own trades belong to the last window's counts too; RecentCounts drops what is too old
        per_ms: dict[int, int] = {int(x["ts"]): int(x["n"]) for x in row["older"]}
        for t in tail:
            per_ms[int(t["trade_time_ms"])] = per_ms.get(int(t["trade_time_ms"]), 0) + 1
        self.recent.put(sorted(per_ms.items()))
        if not pd.isna(row["last_alert_ms"]):
            self.last_alert.update((int(row["last_alert_ms"]),))
        if not pd.isna(row["base_ms"]):
            self.pump_state.update((float(row["base_price"]), int(row["base_ms"]), float(row["peak_price"]), bool(row["expired"])))
        elif not pd.isna(row["expired"]) and row["expired"]:
            self.pump_state.update((None, None, None, True))

    def wash_alerts(self, prices: np.ndarray, quantities: np.ndarray) -> Iterator[tuple]:
        """(row, fields of the alert)"""
        p = self.p
        before = _columns(self.wash, (float, float))
        price, quantity = (Trailing(b, new, p.wash_frame) for b, new in zip(before, (prices, quantities)))
        self.wash.put(list(zip(price.tail(), quantity.tail())))
        high, low = price.fold(np.maximum, -np.inf), price.fold(np.minimum, np.inf)
        swing = ratio(high - low, low) * 100
        size = ratio(quantities, quantity.fold(np.add, 0.0) / quantity.length)
        hit = (price.length >= p.wash_warmup) & (swing >= p.wash_swing_pct) & (size >= p.wash_volume_mult)
        for i in np.flatnonzero(hit):
            lo, hi, moved, times = (float(x[i]) for x in (low, high, swing, size))
            text = WASH_TEXT.format(swing=moved, high=hi, low=lo, ratio=times, n=int(price.length[i]))
            yield i, "WASH_TRADE", _level(moved, p.wash_high_swing), lo, hi, moved, times, text

    def spike_alerts(self, prices: np.ndarray, ts: np.ndarray) -> Iterator[tuple]:
        p = self.p
        seen = RecentCounts(*_columns(self.recent, (np.int64, np.int64)), p.spike_window_ms)
        counts = seen.add(ts)
        history = Trailing(_columns(self.counts, (np.int64,))[0], counts, p.spike_frame)
        self.recent.put(list(zip(seen.at.tolist(), seen.n.tolist())))
        self.counts.put([(n,) for n in history.tail()])
        mean = history.fold(np.add, 0) / history.length
        times = ratio(counts, mean)
        candidates = np.flatnonzero((history.length >= p.spike_warmup) & (times >= p.spike_mult))
        last = self.last_alert.get()[0] if self.last_alert.exists() else 0
        hits = candidates[cooled(ts[candidates], last, p.spike_cooldown_ms)]
        if len(hits):
            self.last_alert.update((int(ts[hits[-1]]),))
        for i in hits:
            text = SPIKE_TEXT.format(count=int(counts[i]), avg=float(mean[i]), ratio=float(times[i]))
            level = _level(times[i], p.spike_high_ratio)
            yield i, "VOLUME_SPIKE", level, None, float(prices[i]), None, float(times[i]), text

    def pump_alerts(self, batch: pd.DataFrame) -> Iterator[tuple]:
        fired: list[tuple] = []
        state = tuple(self.pump_state.get()) if self.pump_state.exists() else self.pump.initial
        self.pump_state.update(self.pump.step(state, batch.assign(trade_id=np.arange(len(batch))), fired.append))
        for i, _, start, price, _, rise, drop, _, text in fired:
            times = rise / drop if drop > 0 else 0.0
            yield i, "PUMP_AND_DUMP", _level(rise + drop, self.p.pump_high_sum), start, price, -drop, times, text

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(
            ["trade_time_ms", "trade_id"], kind="stable", na_position="first"
        )
        if batch.empty:
            return
        prices, quantities = batch["price"].to_numpy(float), batch["quantity"].to_numpy(float)
        ts, ids = batch["trade_time_ms"].to_numpy(np.int64), batch["trade_id"]
        found = [*self.wash_alerts(prices, quantities), *self.spike_alerts(prices, ts), *self.pump_alerts(batch)]
        out = [(key[0], None if pd.isna(ids.iloc[i]) else int(ids.iloc[i]), int(ts[i]), *fields) for i, *fields in found]
        yield pd.DataFrame.from_records(out, columns=_OUT_COLS)

    def close(self) -> None:
        pass


def _level(value: float, high: float) -> str:
    return "HIGH" if value > high else "MEDIUM"


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def require_rocksdb(spark) -> None:
    """transformWithState runs only on the RocksDB state store; select it for
    queries started from now on (a query keeps the provider of its checkpoint)."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def stream_alerts(trades: DataFrame, p: Params = DEFAULT, initial: DataFrame | None = None) -> DataFrame:
    """Streaming trades -> alert rows in the ``anomaly_events`` schema, via
    the stateful processor. No watermark: late trades count. A micro-batch's
    rows of one symbol are sorted together, so bound batch size with the
    source's ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``.

    ``initial``: states (``operators.resume``) that a query without a checkpoint
    starts from, so a stream goes on where a batch run over the history ended."""
    require_rocksdb(trades.sparkSession)
    ship_package(trades.sparkSession)
    t = trades.select("symbol", "trade_id", "price", "quantity", "trade_time_ms")
    out = t.groupBy("symbol").transformWithStateInPandas(
        statefulProcessor=DetectorProcessor(p),
        outputStructType=ALERT_SCHEMA,
        outputMode="Append",
        timeMode="None",
        initialState=None if initial is None else initial.groupBy("symbol"),
    )
    return out.withColumn("detected_at", ms_to_ts("trade_time_ms")).select(*ANOMALY_COLUMNS)
