"""Serving queries over the result tables (candles, alerts, ticker).

Each dashboard / inspection query is a parameterised DataFrame function.
``symbol=None`` answers for every symbol at once (grouped by symbol);
a string restricts to that symbol, as the dashboard variable does.
``as_of`` replaces ``NOW()``: a Python datetime, a Column, or ``None`` for
``current_timestamp()``; ``as_of_from`` derives it from data with a
scalar subquery (no collect to the driver).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.params import DEFAULT, Params

# Fixed display mappings (dashboard): severity -> (colour, sort index)
# HIGH red 0, MEDIUM orange 1, LOW yellow 2; alert-count bands green < 1,
# yellow >= 1, red >= 5; candle direction up when close >= open.
SEVERITY_COLOURS = (("HIGH", "red", 0), ("MEDIUM", "orange", 1), ("LOW", "yellow", 2))
BAND_YELLOW_AT, BAND_RED_AT = 1, 5
DISPLAY_RATIO = "vol_ratio (×avg)"
PATTERNS = ("VOLUME_SPIKE", "WASH_TRADE", "PUMP_AND_DUMP")


def _one_hour() -> Column:
    return F.expr("INTERVAL 1 HOUR")


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        return F.lit(as_of).cast("timestamp_ntz")
    return F.lit(as_of).cast("timestamp_ntz")


def as_of_from(df: DataFrame, col: str) -> Column:
    """``max(col)`` of ``df`` as a scalar subquery column."""
    return df.select(F.max(col)).scalar()


def _for_symbol(df: DataFrame, symbol: str | None) -> DataFrame:
    return df if symbol is None else df.where(F.col("symbol") == F.lit(symbol))


def validate_size(size: str, p: Params = DEFAULT) -> str:
    """Candle-size variable: must be one of the configured sizes."""
    allowed = [label for label, _ in p.candle_sizes]
    if size not in allowed:
        raise ValueError(f"candle size {size!r} not in {allowed}")
    return size


# ------------------------------------------------------------------ ticker
def ticker_panel(ticker: DataFrame, symbol: str | None = None, as_of=None) -> DataFrame:
    """``symbol || ' $' || ROUND(price::numeric, 5)`` and the price of the
    newest ticker row (per symbol). The decimal keeps trailing zeros."""
    label = F.concat(
        F.col("symbol"), F.lit(" $"), F.round(F.col("price").cast("decimal(38,10)"), 5).cast("string")
    )
    t = _for_symbol(ticker, symbol)
    w = Window.partitionBy("symbol").orderBy(F.col("updated_at").desc())
    newest = t.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
    return newest.select(_as_of(as_of).alias("time"), "symbol", label.alias("ticker"), F.col("price"))


def last_not_null(df: DataFrame, value: str, order: str, by: str = "symbol") -> DataFrame:
    """Panel reducer "last non-null": the latest non-null ``value`` per key
    (a partial ``max_by`` over non-null rows, no sort)."""
    return df.where(F.col(value).isNotNull()).groupBy(by).agg(F.max_by(value, order).alias(value))


def ticker_snapshot(ticker: DataFrame) -> DataFrame:
    """Every symbol's latest price, ordered by symbol."""
    return ticker.select("symbol", "price", "price_change_pct", "volume_1min", "updated_at").orderBy("symbol")


# ----------------------------------------------------------------- candles
def candles_last_hour(
    candles: DataFrame, symbol: str | None = None, size: str = "1min", as_of=None, p: Params = DEFAULT
) -> DataFrame:
    """Candles of the last hour for the chart, oldest first, with direction."""
    validate_size(size, p)
    c = _for_symbol(candles, symbol).where(
        (F.col("window_size") == F.lit(size)) & (F.col("window_start") >= _as_of(as_of) - _one_hour())
    )
    return c.select(
        "symbol",
        F.col("window_start").alias("time"),
        F.col("open_price").alias("open"),
        F.col("high_price").alias("high"),
        F.col("low_price").alias("low"),
        F.col("close_price").alias("close"),
        F.col("trade_volume").alias("volume"),
        F.when(F.col("close_price") >= F.col("open_price"), F.lit("up")).otherwise(F.lit("down")).alias("direction"),
    ).orderBy("symbol", "time")


def volume_series(
    candles: DataFrame,
    symbol: str | None = None,
    size: str = "1min",
    time_from=None,
    time_to=None,
    p: Params = DEFAULT,
) -> DataFrame:
    """Volume per candle with an inclusive ``[time_from, time_to]`` range
    (default: the hour before now)."""
    validate_size(size, p)
    to = _as_of(time_to)
    frm = _as_of(time_from) if time_from is not None else to - _one_hour()
    c = _for_symbol(candles, symbol).where(
        (F.col("window_size") == F.lit(size)) & F.col("window_start").between(frm, to)
    )
    return c.select("symbol", F.col("window_start").alias("time"), F.col("trade_volume").alias("volume")).orderBy(
        "symbol", "time"
    )


def symbols(candles: DataFrame) -> DataFrame:
    """Symbol choices: ``SELECT DISTINCT symbol ... ORDER BY symbol``."""
    return candles.select("symbol").distinct().orderBy("symbol")


def latest_candles(candles: DataFrame, limit: int = 10) -> DataFrame:
    """Newest candles (``window_end`` stands in for the insert time)."""
    return candles.orderBy(F.col("window_end").desc(), F.col("window_size").desc(), "symbol").limit(limit).select(
        "symbol", "window_size", "window_end", "open_price", "high_price", "low_price", "close_price", "trade_count"
    )


# ------------------------------------------------------------------ alerts
def anomaly_counts(alerts: DataFrame, symbol: str | None = None, as_of=None, symbols: DataFrame | None = None) -> DataFrame:
    """Alerts per pattern in the last hour, one pass of conditional counts.

    With a symbol: exactly one row (zeros when nothing fired). Without: one
    row per symbol of ``symbols`` (by default those present in ``alerts``).
    """
    recent = F.col("detected_at") >= _as_of(as_of) - _one_hour()
    counts = [
        F.count_if(F.col("pattern_type") == F.lit(pt)).alias(name)
        for pt, name in zip(PATTERNS, ("volume_spikes", "wash_trades", "pump_and_dumps"))
    ]
    if symbol is not None:
        return _for_symbol(alerts, symbol).where(recent).agg(*counts).select(F.lit(symbol).alias("symbol"), "*")
    counted = alerts.where(recent).groupBy("symbol").agg(*counts)  # the time filter reaches the scan
    every = alerts.select("symbol").distinct() if symbols is None else symbols.select("symbol")
    return every.join(counted, "symbol", "left").na.fill(0)


def count_band(n: Column) -> Column:
    return (
        F.when(n >= BAND_RED_AT, F.lit("red")).when(n >= BAND_YELLOW_AT, F.lit("yellow")).otherwise(F.lit("green"))
    )


def anomaly_count_bands(counts: DataFrame) -> DataFrame:
    """One row per (symbol, pattern) with the count and its colour band."""
    long = counts.select(
        "symbol",
        F.expr(
            "stack(3, 'VOLUME_SPIKE', volume_spikes, 'WASH_TRADE', wash_trades, 'PUMP_AND_DUMP', pump_and_dumps)"
        ).alias("pattern_type", "alerts"),
    )
    return long.withColumn("band", count_band(F.col("alerts")))


def _severity_lookup(field: int) -> Column:
    pairs = []
    for sev, colour, rank in SEVERITY_COLOURS:
        pairs += [F.lit(sev), F.lit(colour if field == 1 else rank)]
    return F.try_element_at(F.create_map(*pairs), F.col("severity"))


def alert_table(
    alerts: DataFrame, symbol: str | None = None, as_of=None, limit: int = 100, with_description: bool = True
) -> DataFrame:
    """Alert table: newest first, ``ROUND(pct::numeric, 2)``,
    ``ROUND(ratio::numeric, 1) AS vol_ratio``, severity colour and rank.

    Ties on ``detected_at`` are broken by pattern_type and trade_id so the
    limit is deterministic. Per symbol this is a window top-k, which Spark
    evaluates as a group limit before the shuffle.
    """
    recent = _for_symbol(alerts, symbol).where(F.col("detected_at") >= _as_of(as_of) - _one_hour())
    order = [F.col("detected_at").desc(), F.col("pattern_type"), F.col("trade_id")]
    w = Window.partitionBy("symbol").orderBy(*order)
    top = recent.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= limit)
    cols = [
        "symbol",
        "trade_id",
        "detected_at",
        "pattern_type",
        "severity",
        # ROUND(x::numeric, n): decimal half-up rounding, returned as double
        F.round(F.col("price_change_pct").cast("decimal(38,10)"), 2).cast("double").alias("price_change_pct"),
        F.round(F.col("volume_ratio").cast("decimal(38,10)"), 1).cast("double").alias("vol_ratio"),
        _severity_lookup(1).alias("severity_colour"),
        _severity_lookup(2).alias("severity_rank"),
    ]
    if with_description:
        cols.append("description")
    return top.select(*cols).orderBy("symbol", *order)


def alert_display(table: DataFrame) -> DataFrame:
    """``alert_table`` under the names and with the units that a panel shows."""
    percent = F.concat(F.format_number("price_change_pct", 2), F.lit("%"))
    return table.withColumn("price_change_pct", percent).withColumnRenamed("vol_ratio", DISPLAY_RATIO)


def recent_alerts(alerts: DataFrame, as_of=None, limit: int = 20, with_description: bool = True) -> DataFrame:
    """Newest alerts of all symbols in the last hour (top ``limit``)."""
    recent = alerts.where(F.col("detected_at") >= _as_of(as_of) - _one_hour())
    cols: Sequence = ["symbol", "trade_id", "detected_at", "pattern_type", "severity"]
    if with_description:
        cols = [*cols, "description"]
    return recent.orderBy(F.col("detected_at").desc(), "pattern_type", "symbol", "trade_id").limit(limit).select(*cols)


# ------------------------------------------------------------------ tables
def register_views(spark, **tables: DataFrame) -> list[str]:
    """Expose result relations as temp views and list them (``\\dt``)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(t.name for t in spark.catalog.listTables())
