"""OHLC candles, the latest-price ticker and throughput counters.

Candles are an incremental hash aggregation on ``(symbol, window_start)``:
Spark computes partial aggregates map-side and merges them after one
shuffle, so a hot symbol never lands whole in one task. ``open`` / ``close``
are ``min_by`` / ``max_by`` over ``(trade_time_ms, trade_id)``, both
partial-aggregatable. Coarser sizes are rolled up from the finest size
instead of re-aggregating trades.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.exprs import ms_to_ts, order_key, pct_of, ts_to_ms
from candlewick.params import DEFAULT, Params

CANDLE_COLUMNS = [
    "symbol",
    "window_start",
    "window_end",
    "window_size",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "trade_volume",
    "trade_count",
]


def _bucket_start(ms_col: str, size_ms: int):
    return F.col(ms_col) - F.pmod(F.col(ms_col), F.lit(size_ms))


def ohlc(trades: DataFrame, label: str = "1min", size_ms: int = 60_000) -> DataFrame:
    """One candle per (symbol, tumbling window); empty windows yield no row."""
    order = order_key("trade_time_ms", "trade_id")
    agg = trades.groupBy("symbol", _bucket_start("trade_time_ms", size_ms).alias("_ws")).agg(
        F.min_by("price", order).alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max_by("price", order).alias("close_price"),
        F.sum("quantity").alias("trade_volume"),
        F.count(F.lit(1)).cast("int").alias("trade_count"),
    )
    return _finish(agg, label, size_ms)


def rollup(candles: DataFrame, label: str, size_ms: int) -> DataFrame:
    """Coarser candles from finer ones (size must be a multiple of the finer size)."""
    ws_ms = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("window_start"))
    agg = candles.withColumn("_ms", ws_ms).groupBy("symbol", _bucket_start("_ms", size_ms).alias("_ws")).agg(
        F.min_by("open_price", F.col("_ms")).alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", F.col("_ms")).alias("close_price"),
        F.sum("trade_volume").alias("trade_volume"),
        F.sum("trade_count").cast("int").alias("trade_count"),
    )
    return _finish(agg, label, size_ms)


def _finish(agg: DataFrame, label: str, size_ms: int) -> DataFrame:
    return agg.select(
        "symbol",
        ms_to_ts(F.col("_ws")).alias("window_start"),
        ms_to_ts(F.col("_ws") + F.lit(size_ms)).alias("window_end"),
        F.lit(label).alias("window_size"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "trade_volume",
        "trade_count",
    )


def candles(trades: DataFrame, sizes: Sequence[tuple[str, int]] | None = None, p: Params = DEFAULT) -> DataFrame:
    """All candle sizes in one relation (``unionByName``), one trade scan.

    The finest size is aggregated from trades; every size that is a multiple
    of it is rolled up from those candles (one small extra aggregation).
    """
    sizes = sorted(sizes or p.candle_sizes, key=lambda s: s[1])
    base_label, base_ms = sizes[0]
    base = ohlc(trades, base_label, base_ms)
    parts = [base]
    for label, ms in sizes[1:]:
        parts.append(rollup(base, label, ms) if ms % base_ms == 0 else ohlc(trades, label, ms))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def with_change_pct(candles_df: DataFrame) -> DataFrame:
    """Intra-window change ``(close-open)/open*100``, 0.0 when open <= 0."""
    return candles_df.withColumn(
        "price_change_pct", pct_of(F.col("close_price") - F.col("open_price"), F.col("open_price"))
    )


def price_ticker(candles_df: DataFrame, source_sizes: Sequence[str] = ("1min",)) -> DataFrame:
    """Latest-price table: one row per symbol from its newest candle.

    Equivalent to replaying every candle write as an upsert keyed by symbol.
    With several source sizes the largest ``window_end`` wins and a tie goes
    to the later size in ``source_sizes`` (the coarser candle wrote last).
    Partial aggregation keeps this a per-symbol reduce, not a sort.
    """
    rank = {s: i for i, s in enumerate(source_sizes)}
    rank_col = F.lit(0)
    for size, i in rank.items():
        rank_col = F.when(F.col("window_size") == size, F.lit(i)).otherwise(rank_col)
    src = with_change_pct(candles_df.where(F.col("window_size").isin(list(source_sizes))))
    key = order_key(ts_to_ms(F.col("window_end")), rank_col)
    latest = src.groupBy("symbol").agg(
        F.max_by("close_price", key).alias("price"),
        F.max_by("price_change_pct", key).alias("price_change_pct"),
        F.max_by("trade_volume", key).alias("volume_1min"),
        F.max("window_end").alias("updated_at"),
    )
    return latest


def throughput(trades: DataFrame, seconds: int = 10) -> DataFrame:
    """Messages per ``seconds`` bucket, per symbol and in total (symbol NULL).

    ``rollup`` produces both levels from one partial aggregation.
    """
    size_ms = seconds * 1000
    agg = (
        trades.groupBy(_bucket_start("trade_time_ms", size_ms).alias("_ws"), "symbol")
        .agg(F.count(F.lit(1)).alias("messages"))
    )
    total = agg.groupBy("_ws").agg(F.sum("messages").alias("messages")).withColumn("symbol", F.lit(None).cast("string"))
    both = agg.unionByName(total)
    return both.select(
        ms_to_ts(F.col("_ws")).alias("window_start"),
        "symbol",
        "messages",
        (F.col("messages") / F.lit(float(seconds))).alias("msg_per_sec"),
    )

