"""DuckDB formulations of every registered query (the correctness oracle).

They are written independently of the Spark code: plain SQL windows,
``arg_min``/``arg_max`` and recursive CTEs for the two sequential rules.
Tables ``events`` etc. are views registered by the caller.
"""

from __future__ import annotations

from candlewick.params import DEFAULT as P

# trades adapted from events (same constants as candlewick.sources.tables)
TRADES = """
trades AS (
  SELECT event_type AS symbol, event_id AS trade_id,
         100.0 + value / {div} AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) + 1.0 AS quantity,
         CAST(1704067200000 + floor(((epoch_us(ts) // 1000) - 1704067200000) / 50.0) AS BIGINT) AS trade_time_ms
  FROM events
  WHERE event_type IS NOT NULL AND event_id IS NOT NULL AND value IS NOT NULL
    AND json_extract_string(props, '$.k') IS NOT NULL AND ts IS NOT NULL
)"""


def trades_cte(selective: bool = False) -> str:
    return TRADES.format(div="1000.0" if selective else "100.0")


def ohlc_sql(size_ms: int, label: str) -> str:
    return f"""
  SELECT symbol,
         epoch_ms(ws) AS window_start,
         epoch_ms(ws + {size_ms}) AS window_end,
         '{label}' AS window_size,
         arg_min(price, (trade_time_ms, trade_id)) AS open_price,
         max(price) AS high_price,
         min(price) AS low_price,
         arg_max(price, (trade_time_ms, trade_id)) AS close_price,
         sum(quantity) AS trade_volume,
         CAST(count(*) AS INTEGER) AS trade_count
  FROM (SELECT *, trade_time_ms - (trade_time_ms % {size_ms}) AS ws FROM trades) x
  GROUP BY symbol, ws"""


def candles_cte() -> str:
    parts = " UNION ALL ".join(ohlc_sql(ms, label) for label, ms in P.candle_sizes)
    return f"candles AS ({parts})"


def wash_features_cte(div_selective: bool = False) -> str:
    return f"""{trades_cte(div_selective)},
wf AS (
  SELECT *,
    CASE WHEN low > 0 THEN (high - low) / low * 100 ELSE 0.0 END AS swing_pct,
    CASE WHEN avg_quantity > 0 THEN quantity / avg_quantity ELSE 0.0 END AS quantity_ratio
  FROM (SELECT *,
      count(*) OVER w AS window_trades, max(price) OVER w AS high, min(price) OVER w AS low,
      avg(quantity) OVER w AS avg_quantity
    FROM trades
    WINDOW w AS (PARTITION BY symbol ORDER BY trade_time_ms, trade_id ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)) x
)"""


WASH_SELECT = """
SELECT symbol, trade_id, epoch_ms(trade_time_ms) AS detected_at, 'WASH_TRADE' AS pattern_type,
       CASE WHEN swing_pct > 1.5 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       low AS price_start, high AS price_end, swing_pct AS price_change_pct, quantity_ratio AS volume_ratio,
       printf('Price swung %.2f%% (high=%.2f, low=%.2f) with volume %.1fx average across last %d trades',
              swing_pct, high, low, quantity_ratio, window_trades) AS description
FROM wf WHERE window_trades >= 20 AND swing_pct >= 0.3 AND quantity_ratio >= 1.5"""


def spike_features_cte(with_trades: bool = True) -> str:
    head = trades_cte() + "," if with_trades else ""
    return f"""{head}
sc AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY trade_time_ms, trade_id)
          - count(*) OVER (PARTITION BY symbol ORDER BY trade_time_ms
                           RANGE BETWEEN UNBOUNDED PRECEDING AND 10001 PRECEDING) AS recent_count
  FROM trades
),
sf AS (
  SELECT *, CASE WHEN avg_count > 0 THEN recent_count / avg_count ELSE 0.0 END AS spike_ratio
  FROM (SELECT *, count(*) OVER f AS history_len, avg(recent_count) OVER f AS avg_count FROM sc
        WINDOW f AS (PARTITION BY symbol ORDER BY trade_time_ms, trade_id
                     ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)) x
),
cand AS (SELECT * FROM sf WHERE history_len >= 6 AND spike_ratio >= 2.0)"""


# greedy cooldown: first candidate, then the first one more than 30 s later
SPIKES_CTE = """,
r AS (
  SELECT symbol, min(trade_time_ms) AS ts FROM cand GROUP BY symbol
  UNION ALL
  SELECT * FROM (SELECT c.symbol, min(c.trade_time_ms) AS ts
                 FROM r JOIN cand c ON c.symbol = r.symbol AND c.trade_time_ms > r.ts + 30000
                 GROUP BY c.symbol)
),
spikes AS (
  SELECT c.* FROM cand c JOIN r ON c.symbol = r.symbol AND c.trade_time_ms = r.ts
  QUALIFY row_number() OVER (PARTITION BY c.symbol, c.trade_time_ms ORDER BY c.trade_id) = 1
)"""

SPIKE_SELECT = """
SELECT symbol, trade_id, epoch_ms(trade_time_ms) AS detected_at, 'VOLUME_SPIKE' AS pattern_type,
       CASE WHEN spike_ratio > 5.0 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       CAST(NULL AS DOUBLE) AS price_start, price AS price_end, CAST(NULL AS DOUBLE) AS price_change_pct,
       spike_ratio AS volume_ratio,
       printf('%d trades in last 10s vs avg %.1f (%.1fx normal — 10-min rolling baseline)',
              recent_count, avg_count, spike_ratio) AS description
FROM spikes"""


# pump-and-dump state machine as a recursive walk over each symbol's rows
PUMP_CTE = """,
s AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY trade_time_ms, trade_id) AS rn FROM trades),
m AS (
  SELECT symbol, rn, trade_id, price AS b, trade_time_ms AS bt, price AS pk, false AS fired, false AS watching,
         price AS p, trade_time_ms AS ts
  FROM s WHERE rn = 1
  UNION ALL
  SELECT symbol, rn, trade_id, b, bt, pk, f, (NOT w) AND (f OR ts - bt > 240000), p, ts FROM (
    SELECT *, (NOT w) AND (pk - b) / b * 100 >= 0.4 AND (pk - p) / pk * 100 >= 0.3 AND ts - bt <= 240000 AS f
    FROM (
      SELECT s.symbol, s.rn, s.trade_id, m.watching AS w, s.price AS p, s.trade_time_ms AS ts,
             CASE WHEN m.watching THEN s.price ELSE m.b END AS b,
             CASE WHEN m.watching THEN s.trade_time_ms ELSE m.bt END AS bt,
             CASE WHEN m.watching THEN s.price ELSE greatest(m.pk, s.price) END AS pk
      FROM m JOIN s ON s.symbol = m.symbol AND s.rn = m.rn + 1) x) y
),
pumps AS (SELECT symbol, trade_id, ts, bt, b, p, pk, (pk - b) / b * 100 AS rise, (pk - p) / pk * 100 AS dr
          FROM m WHERE fired)"""

PUMP_SELECT = """
SELECT symbol, trade_id, epoch_ms(ts) AS detected_at, 'PUMP_AND_DUMP' AS pattern_type,
       CASE WHEN rise + dr > 3.0 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
       b AS price_start, p AS price_end, -dr AS price_change_pct,
       CASE WHEN dr > 0 THEN rise / dr ELSE 0.0 END AS volume_ratio,
       printf('Pump +%.2f%% to %.2f, then dump -%.2f%% to %.2f in %.0fs', rise, pk, dr, p, (ts - bt) / 1000.0) AS description
FROM pumps"""


# exchange feed derived from events (candlewick.sources.raw), parsed directly
FEED_TRADES = """
feed AS (
  SELECT upper(event_type) || 'USDT' AS symbol, event_id AS trade_id, 100.0 + value / 100.0 AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) + 1.0 AS quantity,
         CAST(1704067200000 + floor(((epoch_us(ts) // 1000) - 1704067200000) / 50.0) AS BIGINT) AS trade_time_ms,
         user_id % 2 = 0 AS is_buyer_mm, event_type, value
  FROM events
)"""

ISO_TIME = """strftime(epoch_ms(trade_time_ms), '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN trade_time_ms % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(trade_time_ms % 1000 AS VARCHAR), 3, '0') || '000' END
  || '+00:00'"""

#: the messages themselves, as text (see ``candlewick.sources.raw``)
FEED_TEXT = """
text AS (
  SELECT *, '{"e":"trade","s":"' || symbol || '","t":' || trade_id || ',"p":' AS a, ',"q":"' || quantity || '"' AS b,
         ',"T":' || trade_time_ms AS c, ',"m":' || is_buyer_mm || '}' AS d, '{"stream":"' || lower(symbol) || '@trade","data":' AS w FROM feed
)"""

FEED_REJECTED = """
SELECT CASE event_type
         WHEN 'click' THEN substr(w || a || '"' || price || '"' || b || c || d || '}', 1, 40)
         WHEN 'signup' THEN w || a || '"n/a"' || b || c || d || '}'
         WHEN 'purchase' THEN w || a || '"' || price || '"' || b || d || '}'
         WHEN 'view' THEN '{"result":null,"id":' || trade_id || '}'
         ELSE w || a || 'null' || b || c || d || '}' END AS value,
       CASE event_type WHEN 'click' THEN 'not_json' WHEN 'signup' THEN 'bad_number'
                       WHEN 'purchase' THEN 'missing_field' WHEN 'view' THEN 'not_trade' ELSE 'null_field' END AS reason
FROM text WHERE value < 2.0"""

FEED_REJECTS = """
SELECT reason, count(*) AS messages FROM (
  SELECT CASE event_type WHEN 'click' THEN 'not_json' WHEN 'signup' THEN 'bad_number'
                         WHEN 'purchase' THEN 'missing_field' WHEN 'view' THEN 'not_trade'
                         ELSE 'null_field' END AS reason
  FROM feed WHERE value < 2.0) x
GROUP BY reason"""


def alerts_cte() -> str:
    """All three patterns as ``alerts`` (recursive CTEs inside)."""
    return (f"{wash_features_cte()}, {spike_features_cte(False)}{SPIKES_CTE}{PUMP_CTE},\n"
            f"alerts AS ({WASH_SELECT} UNION ALL {SPIKE_SELECT} UNION ALL {PUMP_SELECT})")


AS_OF = "(SELECT epoch_ms(max(trade_time_ms)) FROM trades)"

TICKER = """
ticker AS (
  SELECT symbol, arg_max(close_price, window_end) AS price, arg_max(chg, window_end) AS price_change_pct,
         arg_max(trade_volume, window_end) AS volume_1min, max(window_end) AS updated_at
  FROM (SELECT *, CASE WHEN open_price > 0 THEN (close_price - open_price) / open_price * 100 ELSE 0.0 END AS chg
        FROM candles WHERE window_size = '1min') c
  GROUP BY symbol)"""
