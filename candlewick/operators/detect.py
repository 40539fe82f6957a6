"""The three anomaly patterns and the shared alert relation.

* ``wash_trades`` — pure Catalyst: rolling features + filter.
* ``volume_spikes`` — rolling features give candidates; the 30 s cooldown
  (accept when more than 30 s after the last *accepted* alert) is a fold,
  run with ``run_sequential`` over candidates only.
* ``pump_and_dump`` — per symbol, from baseline to baseline: a baseline ends
  with the first dump after a rise or with the timeout, and the trade after
  that is the next one; ``run_sequential`` over all trades.

Both folds jump with array searches: Python runs per accepted alert or
baseline, never per trade.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField

from candlewick.functions.exprs import guarded_div, ms_to_ts, render, severity
from candlewick.operators.features import all_features, spike_features, wash_features, with_chunks
from candlewick.operators.sequential import SequentialRule, combine_rules, run_sequential
from candlewick.params import DEFAULT, PUMP_TEXT, SPIKE_TEXT, WASH_TEXT, Params
from candlewick.session import cut_lineage

ANOMALY_COLUMNS = [
    "symbol",
    "trade_id",
    "detected_at",
    "pattern_type",
    "severity",
    "price_start",
    "price_end",
    "price_change_pct",
    "volume_ratio",
    "description",
]


# ------------------------------------------------------------------ wash
def wash_trades(trades: DataFrame, p: Params = DEFAULT, features: DataFrame | None = None) -> DataFrame:
    """WASH_TRADE per trade: frame >= warm-up, swing >= 0.3 % and
    quantity >= 1.5x the frame's mean quantity. No cooldown."""
    f = features if features is not None else wash_features(trades, p)
    hit = f.where(
        (F.col("window_trades") >= p.wash_warmup)
        & (F.col("swing_pct") >= p.wash_swing_pct)
        & (F.col("quantity_ratio") >= p.wash_volume_mult)
    )
    return hit.select(
        "symbol",
        "trade_id",
        ms_to_ts("trade_time_ms").alias("detected_at"),
        F.lit("WASH_TRADE").alias("pattern_type"),
        severity(F.col("swing_pct"), p.wash_high_swing).alias("severity"),
        F.col("low").alias("price_start"),
        F.col("high").alias("price_end"),
        F.col("swing_pct").alias("price_change_pct"),
        F.col("quantity_ratio").alias("volume_ratio"),
        render(
            WASH_TEXT, swing="swing_pct", high="high", low="low", ratio="quantity_ratio", n="window_trades"
        ).alias("description"),
    )


# ----------------------------------------------------------------- spike
def spike_test(p: Params = DEFAULT):
    return (F.col("history_len") >= p.spike_warmup) & (F.col("spike_ratio") >= p.spike_mult)


def spike_candidates(trades: DataFrame, p: Params = DEFAULT, features: DataFrame | None = None) -> DataFrame:
    """Trades where the spike test holds before the cooldown is applied."""
    f = features if features is not None else spike_features(trades, p)
    return f.where(spike_test(p))


def cooled(ts: np.ndarray, last: int, gap: int) -> list[int]:
    """Positions of rising ``ts`` that are each more than ``gap`` after the
    one accepted before (``last`` at first): one jump per accepted time."""
    out, at = [], int(np.searchsorted(ts, last + gap, "right"))
    while at < len(ts):
        out.append(at)
        at = int(np.searchsorted(ts, ts[at] + gap, "right"))
    return out


def cooldown_rule(p: Params = DEFAULT) -> SequentialRule:
    gap = p.spike_cooldown_ms

    def step(state, rows, emit):
        ts = rows["trade_time_ms"].to_numpy(np.int64)
        hits = cooled(ts, int(state[0] or 0), gap)
        if emit is not None:
            told = rows.iloc[hits][["trade_id", "trade_time_ms", "price", "recent_count", "avg_count", "spike_ratio"]]
            for r in told.itertuples(index=False, name=None):
                emit(r)
        return (int(ts[hits[-1]]) if hits else state[0],)

    def normalize(state, first_ts):
        last = state[0]
        if not last or first_ts - last > gap:
            return (None,)
        return (int(last),)

    def normalize_cols(cols, first_ts):
        last = cols[0]
        return [F.when(last.isNull() | (last == 0) | (first_ts - last > F.lit(gap)), F.lit(None).cast("bigint")).otherwise(last)]

    return SequentialRule(
        name="cooldown",
        input_cols=["price", "recent_count", "avg_count", "spike_ratio"],
        state_fields=[StructField("last_alert_ms", LongType())],
        out_fields=[
            StructField("trade_id", LongType()),
            StructField("trade_time_ms", LongType()),
            StructField("price", DoubleType()),
            StructField("recent_count", LongType()),
            StructField("avg_count", DoubleType()),
            StructField("spike_ratio", DoubleType()),
        ],
        initial=(None,),
        step=step,
        normalize=normalize,
        normalize_cols=normalize_cols,
        ties=["recent_count"],  # a repeated trade counts itself after the first
    )


def volume_spikes(trades: DataFrame, p: Params = DEFAULT, features: DataFrame | None = None) -> DataFrame:
    """VOLUME_SPIKE after the per-symbol greedy 30 s cooldown."""
    cands = spike_candidates(trades, p, features)
    return _spike_alerts(run_sequential(cands, cooldown_rule(p), p.seq_halo_ms), p)


def _spike_alerts(accepted: DataFrame, p: Params) -> DataFrame:
    return accepted.select(
        "symbol",
        "trade_id",
        ms_to_ts("trade_time_ms").alias("detected_at"),
        F.lit("VOLUME_SPIKE").alias("pattern_type"),
        severity(F.col("spike_ratio"), p.spike_high_ratio).alias("severity"),
        F.lit(None).cast("double").alias("price_start"),
        F.col("price").alias("price_end"),
        F.lit(None).cast("double").alias("price_change_pct"),
        F.col("spike_ratio").alias("volume_ratio"),
        render(SPIKE_TEXT, count="recent_count", avg="avg_count", ratio="spike_ratio").alias("description"),
    )


# ------------------------------------------------------------------ pump
LOOK_AHEAD = 256  # rows searched at first after a baseline; doubled while nothing is found


class Dump(NamedTuple):
    start_price: float
    price: float
    peak: float
    rise: float
    drop: float
    elapsed: int


def follow_baseline(
    prices: np.ndarray, ts: np.ndarray, at: int, base: float, since: int, peak: float, p: Params = DEFAULT
) -> tuple[int, Dump | None, float]:
    """Search the rows from ``at`` on (rising ``ts``) for the end of one
    baseline: the row that ends it (``len(ts)`` if none does), the dump if it
    is one (else it is the first row past the timeout) and the peak so far.

    A baseline price of 0 measures each trade against itself; a start time of
    0 counts as unset and never runs out."""
    end = len(ts) if since == 0 else max(at, int(np.searchsorted(ts, since + p.pump_timeout_ms, "right")))
    size = LOOK_AHEAD
    while at < end:
        some = prices[at : min(at + size, end)]
        peaks = np.fmax.accumulate(np.append(peak or -np.inf, some))[1:]
        start = np.full(len(some), base) if base else some
        rise = np.divide(peaks - start, start, out=np.zeros(len(some)), where=start > 0) * 100
        drop = np.divide(peaks - some, peaks, out=np.zeros(len(some)), where=peaks > 0) * 100
        hits = np.flatnonzero((rise >= p.pump_rise_pct) & (drop >= p.pump_drop_pct))
        if len(hits):
            i = int(hits[0])
            elapsed = int(ts[at + i]) - since if since else 0
            return at + i, Dump(*(float(x[i]) for x in (start, some, peaks, rise, drop)), elapsed), float(peaks[i])
        peak, at, size = float(peaks[-1]), at + len(some), size * 2
    return end, None, peak


def pump_rule(p: Params = DEFAULT) -> SequentialRule:
    """State: the baseline's price and time and the peak since (null: the next
    trade is a baseline), and whether it has run out (the next trade only ends it)."""
    timeout = p.pump_timeout_ms

    def step(state, rows, emit):
        base, since, peak, expired = state
        prices, ts = rows["price"].to_numpy(float), rows["trade_time_ms"].to_numpy(np.int64)
        at = 0
        if expired and len(ts):
            at, expired = 1, False
        while at < len(ts):
            if since is None:
                base, since, peak = float(prices[at]), int(ts[at]), float(prices[at])
                at += 1
                continue
            end, dump, peak = follow_baseline(prices, ts, at, base, int(since), peak, p)
            if end == len(ts):
                break
            if dump is not None and emit is not None:
                text = PUMP_TEXT.format(
                    rise=dump.rise, peak=dump.peak, drop=dump.drop, price=dump.price, seconds=dump.elapsed / 1000
                )
                tid = rows["trade_id"].iloc[end]
                emit((None if pd.isna(tid) else int(tid), int(ts[end]), *dump, text))
            base, since, peak, at = None, None, None, end + 1
        return (base, since, peak, bool(expired))

    def normalize(state, first_ts):
        base, since, peak, expired = state
        if expired or (since and first_ts - since > timeout):
            return (None, None, None, True)
        if since is None:
            return (None, None, None, False)
        return (float(base), int(since), float(peak), False)

    def normalize_cols(cols, first_ts):
        base, since, peak, expired = cols
        gone = F.coalesce(expired, F.lit(False)) | F.coalesce(
            (since != 0) & (first_ts - since > F.lit(timeout)), F.lit(False)
        )
        return [*(F.when(~gone, c) for c in (base, since, peak)), gone]

    return SequentialRule(
        name="pump_and_dump",
        input_cols=["price"],
        state_fields=[
            StructField("base_price", DoubleType()),
            StructField("base_ms", LongType()),
            StructField("peak_price", DoubleType()),
            StructField("expired", BooleanType()),
        ],
        out_fields=[
            StructField("trade_id", LongType()),
            StructField("trade_time_ms", LongType()),
            StructField("start_price", DoubleType()),
            StructField("price", DoubleType()),
            StructField("peak_price", DoubleType()),
            StructField("rise_pct", DoubleType()),
            StructField("drop_pct", DoubleType()),
            StructField("elapsed_ms", LongType()),
            StructField("description", StringType()),
        ],
        initial=(None, None, None, False),
        step=step,
        normalize=normalize,
        normalize_cols=normalize_cols,
    )


def pump_and_dump(trades: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """PUMP_AND_DUMP alerts (state machine per symbol, exact, chunk-parallel)."""
    return _pump_alerts(run_sequential(with_chunks(trades, p), pump_rule(p), p.seq_halo_ms), p)


def _pump_alerts(fired: DataFrame, p: Params) -> DataFrame:
    return fired.select(
        "symbol",
        "trade_id",
        ms_to_ts("trade_time_ms").alias("detected_at"),
        F.lit("PUMP_AND_DUMP").alias("pattern_type"),
        severity(F.col("rise_pct") + F.col("drop_pct"), p.pump_high_sum).alias("severity"),
        F.col("start_price").alias("price_start"),
        F.col("price").alias("price_end"),
        (-F.col("drop_pct")).alias("price_change_pct"),
        guarded_div(F.col("rise_pct"), F.col("drop_pct")).alias("volume_ratio"),
        "description",
    )


# --------------------------------------------------------------- all three
def anomaly_events(trades: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """One alert relation for all patterns (``unionByName``).

    Trades are chunked once; wash and spike features come from one sort per
    chunk, written once for the rules that read them, and the two sequential
    rules (pump state machine over all trades, spike cooldown over candidates)
    are folded in one pass.
    """
    f = cut_lineage(all_features(trades, p), "features")
    rule = combine_rules([(pump_rule(p), None), (cooldown_rule(p), "_spike_candidate")], "alerts")
    folded = run_sequential(f.withColumn("_spike_candidate", spike_test(p)), rule, p.seq_halo_ms)

    def part(i: int, r: SequentialRule) -> DataFrame:
        cols = [F.col(f"{r.name}__{x.name}").alias(x.name) for x in r.out_fields]
        return folded.where(F.col("_rule") == i).select("symbol", *cols)

    return (
        wash_trades(None, p, features=f)
        .unionByName(_spike_alerts(part(1, cooldown_rule(p)), p))
        .unionByName(_pump_alerts(part(0, pump_rule(p)), p))
        .select(*ANOMALY_COLUMNS)
    )
