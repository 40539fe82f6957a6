"""Per-trade rolling features behind the wash-trade and volume-spike rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.exprs import guarded_div, pct_of
from candlewick.operators.chunks import assign_chunks, recent_count, rolling_rows, with_frame_halo
from candlewick.params import DEFAULT, Params


def with_chunks(trades: DataFrame, p: Params = DEFAULT) -> DataFrame:
    if "chunk" in trades.columns:
        return trades
    return assign_chunks(trades, p)


def _wash_aggs(w):
    return [
        F.count(F.lit(1)).over(w).alias("window_trades"),
        F.max("price").over(w).alias("high"),
        F.min("price").over(w).alias("low"),
        F.avg("quantity").over(w).alias("avg_quantity"),
    ]


def _spike_aggs(w):
    return [
        F.count(F.lit(1)).over(w).alias("history_len"),
        F.avg("recent_count").over(w).alias("avg_count"),
    ]


def _wash_derived(f: DataFrame) -> DataFrame:
    return f.withColumn("swing_pct", pct_of(F.col("high") - F.col("low"), F.col("low"))).withColumn(
        "quantity_ratio", guarded_div(F.col("quantity"), F.col("avg_quantity"))
    )


def _spike_derived(f: DataFrame) -> DataFrame:
    return f.withColumn("spike_ratio", guarded_div(F.col("recent_count").cast("double"), F.col("avg_count")))


def _counted(trades: DataFrame, p: Params) -> DataFrame:
    """The rows of every chunk and its halo with their 10 s counts."""
    t = with_chunks(trades, p)
    return recent_count(with_frame_halo(t), t, p.spike_window_ms)


def _no_copies(f: DataFrame) -> DataFrame:
    return f.where(~F.col("_copy")).drop("_copy", "halo_chunks", "next_cut")


def all_features(trades: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Wash and spike features in one pass: the 10 s count needs its own
    window, and the same sort per chunk evaluates both 60-trade frames."""
    f = rolling_rows(rolling_rows(_counted(trades, p), p.wash_frame, _wash_aggs), p.spike_frame, _spike_aggs)
    return _spike_derived(_wash_derived(_no_copies(f)))


def wash_features(trades: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Last-``wash_frame``-trades statistics per trade.

    Columns added: ``window_trades`` (frame length so far), ``high``,
    ``low``, ``avg_quantity``, ``swing_pct`` ((high-low)/low*100, 0 if
    low <= 0) and ``quantity_ratio`` (quantity/avg, 0 if avg <= 0).
    """
    copies = with_frame_halo(with_chunks(trades, p))
    return _wash_derived(_no_copies(rolling_rows(copies, p.wash_frame, _wash_aggs)))


def spike_features(trades: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Trades-in-the-last-10-s and its rolling baseline per trade.

    Columns added: ``recent_count`` (trades with ts >= ts_i - 10 s seen so
    far), ``history_len`` (snapshots in the baseline, at most
    ``spike_frame``), ``avg_count`` (mean of the last ``spike_frame``
    snapshots) and ``spike_ratio`` (recent/avg, 0 if avg <= 0).
    """
    return _spike_derived(_no_copies(rolling_rows(_counted(trades, p), p.spike_frame, _spike_aggs)))
