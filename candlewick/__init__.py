"""candlewick — Spark-native trade-stream analytics.

Parse and validate trades, build OHLC candles, detect wash-trade /
volume-spike / pump-and-dump patterns, keep a latest-price table and
answer the serving queries, on batch tables and on Structured Streaming.
"""

from candlewick.params import Params

__all__ = ["Params"]
