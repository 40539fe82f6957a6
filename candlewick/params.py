"""All thresholds, frame lengths and window sizes in one place."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values that must equal the reference's defaults for equal results:
# wash swing 0.3 %, wash volume 1.5x, pump rise 0.4 %, pump drop 0.3 %,
# spike 2.0x; wash frame 60 trades with a 20-trade warm-up; spike window
# 10 000 ms, baseline 60 snapshots, warm-up 6, cooldown 30 000 ms; pump
# timeout 240 000 ms; severity cut-offs wash 1.5, pump 3.0, spike 5.0.
# Symbols and their log partitions: BTCUSDT 0, ETHUSDT 1, BNBUSDT 2,
# SOLUSDT 3, DOGEUSDT 4, XRPUSDT 5; unknown symbols go to partition 0.
# Fixed text formats (Python format syntax) of alert descriptions and of the
# producer's preview line:
WASH_TEXT = (
    "Price swung {swing:.2f}% (high={high:.2f}, low={low:.2f}) "
    "with volume {ratio:.1f}x average across last {n} trades"
)
SPIKE_TEXT = "{count} trades in last 10s vs avg {avg:.1f} ({ratio:.1f}x normal — 10-min rolling baseline)"
PUMP_TEXT = "Pump +{rise:.2f}% to {peak:.2f}, then dump -{drop:.2f}% to {price:.2f} in {seconds:.0f}s"
PREVIEW_TEXT = "[dry-run]  {symbol:<10}  price={price:>12,.2f}  qty={qty:>12.6f}"
DEFAULT_SYMBOL_PARTITIONS = (
    ("BTCUSDT", 0),
    ("ETHUSDT", 1),
    ("BNBUSDT", 2),
    ("SOLUSDT", 3),
    ("DOGEUSDT", 4),
    ("XRPUSDT", 5),
)


@dataclass(frozen=True)
class Params:
    # wash trade
    wash_swing_pct: float = 0.3
    wash_volume_mult: float = 1.5
    wash_frame: int = 60
    wash_warmup: int = 20
    wash_high_swing: float = 1.5
    # pump and dump
    pump_rise_pct: float = 0.4
    pump_drop_pct: float = 0.3
    pump_timeout_ms: int = 240_000
    pump_high_sum: float = 3.0
    # volume spike
    spike_mult: float = 2.0
    spike_window_ms: int = 10_000
    spike_frame: int = 60
    spike_warmup: int = 6
    spike_cooldown_ms: int = 30_000
    spike_high_ratio: float = 5.0
    # candles
    candle_sizes: tuple[tuple[str, int], ...] = (("1min", 60_000), ("5min", 300_000))
    # routing
    symbol_partitions: tuple[tuple[str, int], ...] = DEFAULT_SYMBOL_PARTITIONS
    # scale-out: time grain of the chunk planner and rows per chunk. With
    # chunk_rows=None the size adapts: total rows / (2 x cluster parallelism),
    # clamped to [min_chunk_rows, max_chunk_rows]
    grain_ms: int = 60_000
    chunk_rows: int | None = None
    min_chunk_rows: int = 20_000
    max_chunk_rows: int = 2_000_000
    # speculative look-back for the sequential detectors (ms of the
    # previous chunk replayed before a chunk's own rows)
    seq_halo_ms: int = 600_000
    seq_halo_rows: int = 50_000


DEFAULT = Params()
