"""Registered queries: name -> (spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candlewick.operators import candles as C
from candlewick.plans import oracle as O
from candlewick.sources.tables import load_trades

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- candles
@register("ohlc_1min", f"WITH {O.trades_cte()} {O.ohlc_sql(60000, '1min')}")
def q_ohlc_1min(spark, sf):
    return C.ohlc(load_trades(spark, sf), "1min", 60_000)


@register("ohlc_5min", f"WITH {O.trades_cte()} {O.ohlc_sql(300000, '5min')}")
def q_ohlc_5min(spark, sf):
    return C.ohlc(load_trades(spark, sf), "5min", 300_000)


@register("ohlc_candles", f"WITH {O.trades_cte()}, {O.candles_cte()} SELECT * FROM candles")
def q_ohlc_candles(spark, sf):
    return C.candles(load_trades(spark, sf))


@register(
    "price_ticker",
    f"""WITH {O.trades_cte()}, {O.candles_cte()},
c AS (SELECT *, CASE WHEN open_price > 0 THEN (close_price - open_price) / open_price * 100 ELSE 0.0 END AS chg
      FROM candles WHERE window_size = '1min')
SELECT symbol, arg_max(close_price, window_end) AS price, arg_max(chg, window_end) AS price_change_pct,
       arg_max(trade_volume, window_end) AS volume_1min, max(window_end) AS updated_at
FROM c GROUP BY symbol""",
)
def q_price_ticker(spark, sf):
    return C.price_ticker(C.candles(load_trades(spark, sf)))


@register(
    "throughput_10s",
    f"""WITH {O.trades_cte()},
b AS (SELECT trade_time_ms - (trade_time_ms % 10000) AS ws, symbol FROM trades)
SELECT epoch_ms(ws) AS window_start, symbol, count(*) AS messages, count(*) / 10.0 AS msg_per_sec FROM b GROUP BY ws, symbol
UNION ALL
SELECT epoch_ms(ws) AS window_start, NULL AS symbol, count(*) AS messages, count(*) / 10.0 AS msg_per_sec FROM b GROUP BY ws""",
)
def q_throughput(spark, sf):
    return C.throughput(load_trades(spark, sf), 10)


# --------------------------------------------------------------- detectors
from candlewick.operators import detect as D  # noqa: E402
from candlewick.operators import features as FE  # noqa: E402

_ALERT_COLS = list(D.ANOMALY_COLUMNS)
_WASH_FEATURE_COLS = ["symbol", "trade_id", "trade_time_ms", "window_trades", "high", "low", "avg_quantity",
                      "swing_pct", "quantity_ratio"]
_SPIKE_FEATURE_COLS = ["symbol", "trade_id", "trade_time_ms", "price", "recent_count", "history_len", "avg_count",
                       "spike_ratio"]


@register("wash_features", f"WITH {O.wash_features_cte()} SELECT {', '.join(_WASH_FEATURE_COLS)} FROM wf")
def q_wash_features(spark, sf):
    return FE.wash_features(load_trades(spark, sf)).select(*_WASH_FEATURE_COLS)


@register("wash_trades", f"WITH {O.wash_features_cte()} {O.WASH_SELECT}")
def q_wash_trades(spark, sf):
    return D.wash_trades(load_trades(spark, sf)).select(*_ALERT_COLS)


@register("wash_trades_selective", f"WITH {O.wash_features_cte(True)} {O.WASH_SELECT}")
def q_wash_trades_selective(spark, sf):
    return D.wash_trades(load_trades(spark, sf, selective=True)).select(*_ALERT_COLS)


@register("spike_features", f"WITH {O.spike_features_cte()} SELECT {', '.join(_SPIKE_FEATURE_COLS)} FROM sf")
def q_spike_features(spark, sf):
    return FE.spike_features(load_trades(spark, sf)).select(*_SPIKE_FEATURE_COLS)


@register("spike_candidates", f"WITH {O.spike_features_cte()} SELECT {', '.join(_SPIKE_FEATURE_COLS)} FROM cand")
def q_spike_candidates(spark, sf):
    return D.spike_candidates(load_trades(spark, sf)).select(*_SPIKE_FEATURE_COLS)


@register("volume_spikes", f"WITH RECURSIVE {O.spike_features_cte()}{O.SPIKES_CTE} {O.SPIKE_SELECT}")
def q_volume_spikes(spark, sf):
    return D.volume_spikes(load_trades(spark, sf)).select(*_ALERT_COLS)


@register("pump_and_dump", f"WITH RECURSIVE {O.trades_cte()}{O.PUMP_CTE} {O.PUMP_SELECT}")
def q_pump_and_dump(spark, sf):
    return D.pump_and_dump(load_trades(spark, sf)).select(*_ALERT_COLS)


@register(
    "anomaly_events",
    f"WITH RECURSIVE {O.alerts_cte()} SELECT * FROM alerts",
)
def q_anomaly_events(spark, sf):
    return D.anomaly_events(load_trades(spark, sf)).select(*_ALERT_COLS)


# ------------------------------------------------------------------ ingest
from candlewick.operators import ingest as I  # noqa: E402
from candlewick.params import Params  # noqa: E402
from candlewick.sources.raw import raw_messages  # noqa: E402
from candlewick.sources.tables import read_table  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

# routing table used for the derived feed (ERRORUSDT is left unknown -> 0)
FEED_PARTITIONS = Params(symbol_partitions=(("CLICKUSDT", 1), ("VIEWUSDT", 2), ("PURCHASEUSDT", 3), ("SIGNUPUSDT", 4)))


def _feed(spark, sf):
    return raw_messages(read_table(spark, sf, "events"))


@register(
    "normalize_trades",
    f"WITH {O.FEED_TRADES} SELECT symbol, trade_id, price, quantity, trade_time_ms, {O.ISO_TIME} AS trade_time, "
    "is_buyer_mm FROM feed",
)
def q_normalize_trades(spark, sf):
    return I.normalize_trades(_feed(spark, sf))


@register("rejected_trades", f"WITH {O.FEED_TRADES} {O.FEED_REJECTS}")
def q_rejected_trades(spark, sf):
    return I.rejected_trades(_feed(spark, sf)).groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))


@register("rejected_messages", f"WITH {O.FEED_TRADES}, {O.FEED_TEXT} {O.FEED_REJECTED}")
def q_rejected_messages(spark, sf):
    return I.rejected_trades(_feed(spark, sf))


@register("parse_trades", f"WITH {O.FEED_TRADES} SELECT symbol, trade_id, price, quantity, trade_time_ms FROM feed")
def q_parse_trades(spark, sf):
    msgs = I.serialize_trades(I.normalize_trades(_feed(spark, sf)))
    return I.parse_trades(msgs).select("symbol", "trade_id", "price", "quantity", "trade_time_ms")


@register(
    "trade_partition_routing",
    f"""WITH {O.FEED_TRADES} SELECT symbol, trade_id,
  CAST(CASE symbol WHEN 'CLICKUSDT' THEN 1 WHEN 'VIEWUSDT' THEN 2 WHEN 'PURCHASEUSDT' THEN 3
                   WHEN 'SIGNUPUSDT' THEN 4 ELSE 0 END AS INTEGER) AS partition FROM feed""",
)
def q_routing(spark, sf):
    return I.route_trades(I.normalize_trades(_feed(spark, sf)), FEED_PARTITIONS).select("symbol", "trade_id", "partition")


@register(
    "routed_messages",
    f"""WITH {O.FEED_TRADES} SELECT symbol AS key, '{{"symbol":"' || symbol || '","trade_id":' || trade_id || ',"price":' || price
  || ',"quantity":' || quantity || ',"trade_time_ms":' || trade_time_ms || ',"trade_time":"' || {O.ISO_TIME} || '","is_buyer_mm":' || is_buyer_mm || '}}' AS value,
  CAST(CASE symbol WHEN 'CLICKUSDT' THEN 1 WHEN 'VIEWUSDT' THEN 2 WHEN 'PURCHASEUSDT' THEN 3
                   WHEN 'SIGNUPUSDT' THEN 4 ELSE 0 END AS INTEGER) AS partition FROM feed""",
)
def q_routed_messages(spark, sf):
    routed = I.route_trades(I.normalize_trades(_feed(spark, sf)), FEED_PARTITIONS)
    return routed.select(F.col("key").cast("string").alias("key"), "value", "partition")


@register(
    "trade_preview",
    f"""WITH {O.FEED_TRADES} SELECT symbol, trade_id,
  '[dry-run]  ' || CASE WHEN length(symbol) >= 10 THEN symbol ELSE rpad(symbol, 10, ' ') END
  || '  price=' || lpad(format('{{:,.2f}}', price), 12, ' ') || '  qty=' || lpad(printf('%.6f', quantity), 12, ' ') AS line
FROM feed""",
)
def q_trade_preview(spark, sf):
    return I.preview_lines(I.normalize_trades(_feed(spark, sf)))


# ----------------------------------------------------------------- serving
from candlewick.plans import serving as SV  # noqa: E402


def _results(spark, sf, alerts: bool = False):
    """Result tables derived from the events table, and ``as_of`` = the
    newest trade time (a scalar subquery, no driver round trip)."""
    t = load_trades(spark, sf)
    as_of = SV.as_of_from(t, "event_ts")
    c = C.candles(t)
    out = {"trades": t, "candles": c, "ticker": C.price_ticker(c), "as_of": as_of}
    if alerts:
        out["alerts"] = D.anomaly_events(t)
    return out


_C = f"WITH {O.trades_cte()}, {O.candles_cte()}"
_CT = f"{_C}, {O.TICKER}"
_CA = f"WITH RECURSIVE {O.alerts_cte()}"


@register(
    "ticker_panel",
    f"""{_CT} SELECT {O.AS_OF} AS time, symbol,
  symbol || ' $' || CAST(round(CAST(price AS DECIMAL(38,10)), 5) AS VARCHAR) AS ticker, price FROM ticker""",
)
def q_ticker_panel(spark, sf):
    r = _results(spark, sf)
    return SV.ticker_panel(r["ticker"], None, r["as_of"])


@register("ticker_snapshot", f"{_CT} SELECT symbol, price, price_change_pct, volume_1min, updated_at FROM ticker")
def q_ticker_snapshot(spark, sf):
    return SV.ticker_snapshot(_results(spark, sf)["ticker"])


@register(
    "candles_last_hour",
    f"""{_C} SELECT symbol, window_start AS time, open_price AS open, high_price AS high, low_price AS low,
  close_price AS close, trade_volume AS volume, CASE WHEN close_price >= open_price THEN 'up' ELSE 'down' END AS direction
FROM candles WHERE window_size = '1min' AND window_start >= {O.AS_OF} - INTERVAL 1 HOUR""",
)
def q_candles_last_hour(spark, sf):
    r = _results(spark, sf)
    return SV.candles_last_hour(r["candles"], None, "1min", r["as_of"])


@register(
    "volume_series",
    f"""{_C} SELECT symbol, window_start AS time, trade_volume AS volume FROM candles
WHERE window_size = '5min' AND window_start BETWEEN {O.AS_OF} - INTERVAL 6 HOUR AND {O.AS_OF}""",
)
def q_volume_series(spark, sf):
    r = _results(spark, sf)
    return SV.volume_series(r["candles"], None, "5min", r["as_of"] - F.expr("INTERVAL 6 HOUR"), r["as_of"])


@register("symbols", f"{_C} SELECT DISTINCT symbol FROM candles")
def q_symbols(spark, sf):
    return SV.symbols(_results(spark, sf)["candles"])


@register(
    "latest_candles",
    f"""{_C} SELECT symbol, window_size, window_end, open_price, high_price, low_price, close_price, trade_count
FROM candles ORDER BY window_end DESC, window_size DESC, symbol LIMIT 10""",
)
def q_latest_candles(spark, sf):
    return SV.latest_candles(_results(spark, sf)["candles"], 10)


_COUNTS_SQL = f"""
  SELECT symbol,
    count(*) FILTER (WHERE pattern_type = 'VOLUME_SPIKE' AND detected_at >= {O.AS_OF} - INTERVAL 1 HOUR) AS volume_spikes,
    count(*) FILTER (WHERE pattern_type = 'WASH_TRADE' AND detected_at >= {O.AS_OF} - INTERVAL 1 HOUR) AS wash_trades,
    count(*) FILTER (WHERE pattern_type = 'PUMP_AND_DUMP' AND detected_at >= {O.AS_OF} - INTERVAL 1 HOUR) AS pump_and_dumps
  FROM alerts GROUP BY symbol"""


@register("anomaly_counts", f"{_CA} {_COUNTS_SQL}")
def q_anomaly_counts(spark, sf):
    r = _results(spark, sf, alerts=True)
    return SV.anomaly_counts(r["alerts"], None, r["as_of"])


@register(
    "anomaly_count_bands",
    f"""{_CA}, counts AS ({_COUNTS_SQL}),
long AS (SELECT symbol, 'VOLUME_SPIKE' AS pattern_type, volume_spikes AS alerts FROM counts
         UNION ALL SELECT symbol, 'WASH_TRADE', wash_trades FROM counts
         UNION ALL SELECT symbol, 'PUMP_AND_DUMP', pump_and_dumps FROM counts)
SELECT symbol, pattern_type, alerts, CASE WHEN alerts >= 5 THEN 'red' WHEN alerts >= 1 THEN 'yellow' ELSE 'green' END AS band
FROM long""",
)
def q_anomaly_count_bands(spark, sf):
    r = _results(spark, sf, alerts=True)
    return SV.anomaly_count_bands(SV.anomaly_counts(r["alerts"], None, r["as_of"]))


@register(
    "alert_table",
    f"""{_CA} SELECT symbol, trade_id, detected_at, pattern_type, severity,
  CAST(round(CAST(price_change_pct AS DECIMAL(38,10)), 2) AS DOUBLE) AS price_change_pct,
  CAST(round(CAST(volume_ratio AS DECIMAL(38,10)), 1) AS DOUBLE) AS vol_ratio,
  CASE severity WHEN 'HIGH' THEN 'red' WHEN 'MEDIUM' THEN 'orange' WHEN 'LOW' THEN 'yellow' END AS severity_colour,
  CASE severity WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'LOW' THEN 2 END AS severity_rank,
  description
FROM alerts WHERE detected_at >= {O.AS_OF} - INTERVAL 1 HOUR
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY detected_at DESC, pattern_type, trade_id) <= 100""",
)
def q_alert_table(spark, sf):
    r = _results(spark, sf, alerts=True)
    return SV.alert_table(r["alerts"], None, r["as_of"], 100)


@register(
    "recent_alerts",
    f"""{_CA} SELECT symbol, trade_id, detected_at, pattern_type, severity, description
FROM alerts WHERE detected_at >= {O.AS_OF} - INTERVAL 1 HOUR
ORDER BY detected_at DESC, pattern_type, symbol, trade_id LIMIT 20""",
)
def q_recent_alerts(spark, sf):
    r = _results(spark, sf, alerts=True)
    return SV.recent_alerts(r["alerts"], r["as_of"], 20)


# -------------------------------------------------- from stored result tables
# The same answers from catalog tables (bucketed by symbol, partitioned by
# date), which are written once per session and table folder.
import datetime as dt  # noqa: E402
import uuid  # noqa: E402

from candlewick.plans import periods as PD  # noqa: E402
from candlewick.plans import store as ST  # noqa: E402
from candlewick.session import ensure_checkpoint_dir, scratch_folder  # noqa: E402

_STORES: dict[tuple[str, str], ST.Store] = {}


def stored(spark, sf) -> ST.Store:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORES:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/candlewick/store-{uuid.uuid4().hex}"
        _STORES[key] = ST.build(load_trades(spark, sf), root)
    return _STORES[key]


def _register_stored(name: str, query: Callable[[ST.Store], DataFrame]) -> None:
    register(f"stored_{name}", ORACLE[name])(lambda spark, sf: query(stored(spark, sf)))


for _name, _query in {
    "ticker_panel": lambda s: s.ticker_panel(),
    "ticker_snapshot": lambda s: s.ticker_snapshot(),
    "candles_last_hour": lambda s: s.candles_last_hour(),
    "volume_series": lambda s: s.volume_series(None, "5min", s.as_of - dt.timedelta(hours=6), s.as_of),
    "symbols": lambda s: s.symbols(),
    "latest_candles": lambda s: s.latest_candles(),
    "anomaly_counts": lambda s: s.anomaly_counts(),
    "anomaly_count_bands": lambda s: s.anomaly_count_bands(),
    "alert_table": lambda s: s.alert_table(),
    "recent_alerts": lambda s: s.recent_alerts(),
}.items():
    _register_stored(_name, _query)


# ----------------------------------------- period by period from saved states
PERIOD_MS = 6 * 3_600_000  # the adapted feed spans a good half day


@register("backfill_alerts", ORACLE["anomaly_events"])
def q_backfill_alerts(spark, sf):
    base = scratch_folder(spark, "periods")
    PD.write_trades(load_trades(spark, sf), f"{base}/trades", PERIOD_MS)
    periods = PD.periods_of(spark, f"{base}/trades")
    if not periods:
        return D.anomaly_events(load_trades(spark, sf)).select(*_ALERT_COLS)
    alerts = PD.run_periods(spark, f"{base}/trades", f"{base}/out", periods[0], periods[-1] + PERIOD_MS, period_ms=PERIOD_MS)
    return alerts.select(*_ALERT_COLS)


# ------------------------------------------- the same results across chunk edges
# chunks of about 200 trades: ten or more per symbol at sf0.01, so halos, chunk
# heads and (without a look-back) re-folds all take part
@register("anomaly_events_chunked", ORACLE["anomaly_events"])
def q_anomaly_events_chunked(spark, sf):
    return D.anomaly_events(load_trades(spark, sf), Params(chunk_rows=200))


@register("pump_and_dump_chunked", ORACLE["pump_and_dump"])
def q_pump_and_dump_chunked(spark, sf):
    return D.pump_and_dump(load_trades(spark, sf), Params(chunk_rows=200, seq_halo_ms=0))
