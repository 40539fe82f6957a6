"""Hand-made scenarios, one per rule edge (FIXTURES.md §4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick.functions.exprs import ms_to_ts
from candlewick.operators import candles as C
from candlewick.operators import detect as D
from candlewick.operators import features as FE
from candlewick.operators import ingest as I
from candlewick.operators.sequential import run_sequential
from candlewick.params import Params
from candlewick.plans import serving as SV

T0 = 1_704_110_400_000  # 2024-01-01 12:00:00 UTC
SMALL = Params(chunk_rows=7)  # many chunks: every scenario also crosses chunk edges


def trades(spark, rows):
    """rows: (symbol, trade_id, price, quantity, ms)"""
    df = spark.createDataFrame(rows, "symbol string, trade_id long, price double, quantity double, trade_time_ms long")
    return df.withColumn("event_ts", ms_to_ts("trade_time_ms"))


def one(spark, prices, qtys=None, step=1000, sym="S", t0=T0):
    qtys = qtys or [1.0] * len(prices)
    return trades(spark, [(sym, i + 1, float(p), float(q), t0 + i * step) for i, (p, q) in enumerate(zip(prices, qtys))])


# ------------------------------------------------------------------ candles
def test_g1_g2_g4_candle_basics(spark):
    t = trades(spark, [("S", 1, 10.0, 1.0, T0 + 1), ("S", 2, 12.0, 2.0, T0 + 2), ("S", 3, 11.0, 3.0, T0 + 3),
                       ("S", 4, 50.0, 1.0, T0 + 60_000), ("S", 5, 51.0, 1.0, T0 + 180_000)])
    c = C.ohlc(t).orderBy("window_start").collect()
    assert (c[0].open_price, c[0].high_price, c[0].low_price, c[0].close_price) == (10.0, 12.0, 10.0, 11.0)
    assert c[0].trade_count == 3 and c[0].trade_volume == 6.0
    # G2: 12:01:00.000 opens the next window
    assert c[1].window_start == dt.datetime(2024, 1, 1, 12, 1) and c[1].trade_count == 1
    # G4: no candle for 12:02
    assert [r.window_start.minute for r in c] == [0, 1, 3]


def test_g3_same_ms_orders_by_trade_id(spark):
    t = trades(spark, [("S", 9, 5.0, 1.0, T0), ("S", 3, 7.0, 1.0, T0)])
    r = C.ohlc(t).first()
    assert r.open_price == 7.0 and r.close_price == 5.0


def test_g5_zero_open_price_change_is_zero(spark):
    t = trades(spark, [("S", 1, 0.0, 1.0, T0), ("S", 2, 5.0, 1.0, T0 + 1)])
    tick = C.price_ticker(C.candles(t)).first()
    assert tick.price_change_pct == 0.0 and tick.price == 5.0


def test_rollup_equals_direct_five_minute_candles(spark):
    rows = [("S", i, 100.0 + (i * 7 % 13), float(i % 5 + 1), T0 + i * 17_000) for i in range(200)]
    t = trades(spark, rows)
    direct = C.ohlc(t, "5min", 300_000).orderBy("window_start").collect()
    rolled = C.candles(t).where("window_size = '5min'").orderBy("window_start").collect()
    assert direct == rolled


def test_ticker_source_sizes_tie_goes_to_coarser(spark):
    t = trades(spark, [("S", 1, 10.0, 1.0, T0), ("S", 2, 20.0, 1.0, T0 + 299_000)])
    c = C.candles(t)
    one_min = C.price_ticker(c).first()
    both = C.price_ticker(c, ("1min", "5min")).first()
    assert one_min.volume_1min == 1.0 and both.volume_1min == 2.0  # 5-min candle wrote last


# --------------------------------------------------------------------- wash
def wash(spark, prices, qtys, p=SMALL):
    return D.wash_trades(one(spark, prices, qtys), p).orderBy("trade_id").collect()


def test_g6_warmup_twenty_trades(spark):
    prices = [100.0, 101.0] * 10
    qtys = [float(2 ** i) for i in range(20)]
    got = wash(spark, prices, qtys)
    assert [r.trade_id for r in got] == [20]


def test_g7_trade_61_pushes_extreme_out(spark):
    base = [200.0] + [100.0] * 59
    q = [1.0] * 60
    with_extreme = wash(spark, base, q[:-1] + [10.0])
    assert [r.trade_id for r in with_extreme] == [60]
    without = wash(spark, base + [100.0], q + [10.0])
    assert [r.trade_id for r in without] == []  # trade 61: swing 0, no alert


def test_g8_g9_boundaries_inclusive_and_strict(spark):
    # swing exactly 0.3 (1000 -> 1003) and ratio exactly 1.5 (3 / mean 2)
    prices = [1000.0, 1003.0] + [1000.0] * 18
    qtys = [2.0] * 18 + [1.0, 3.0]
    got = wash(spark, prices, qtys)
    assert [r.trade_id for r in got] == [20]
    assert got[0].price_change_pct == 0.3 and got[0].volume_ratio == 1.5 and got[0].severity == "MEDIUM"
    # swing exactly 1.5 (50 -> 50.75) is still MEDIUM (strict >)
    got = wash(spark, [50.0, 50.75] + [50.0] * 18, qtys)
    assert got[0].price_change_pct == 1.5 and got[0].severity == "MEDIUM"
    got = wash(spark, [50.0, 51.0] + [50.0] * 18, qtys)
    assert got[0].severity == "HIGH"


def test_g10_no_cooldown_for_wash(spark):
    prices = [100.0, 101.0] * 11
    qtys = [1.0] * 20 + [5.0, 6.0]
    got = wash(spark, prices, qtys)
    assert [r.trade_id for r in got] == [21, 22]
    assert got[0].description == (
        f"Price swung 1.00% (high=101.00, low=100.00) with volume {5 / (25 / 21):.1f}x average across last 21 trades"
    )


# -------------------------------------------------------------------- spike
def test_g11_ten_second_edge(spark):
    t = trades(spark, [("S", 1, 1.0, 1.0, T0), ("S", 2, 1.0, 1.0, T0 + 10_000), ("S", 3, 1.0, 1.0, T0 + 10_001),
                       ("S", 4, 1.0, 1.0, T0 + 20_001), ("S", 5, 1.0, 1.0, T0 + 20_001)])
    got = {r.trade_id: r.recent_count for r in FE.spike_features(t, SMALL).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 2, 5: 3}


def test_g12_six_snapshots_warmup(spark):
    t = one(spark, [1.0] * 7, step=20_000)
    f = FE.spike_features(t, SMALL).orderBy("trade_id").collect()
    assert [r.history_len for r in f] == [1, 2, 3, 4, 5, 6, 7]
    assert D.spike_candidates(t, SMALL).count() == 0


def _candidates(spark, times, ratios=None):
    ratios = ratios or [3.0] * len(times)
    df = spark.createDataFrame(
        [("S", i + 1, 1.0, 3, 1.0, r, T0 + ms) for i, (ms, r) in enumerate(zip(times, ratios))],
        "symbol string, trade_id long, price double, recent_count long, avg_count double, spike_ratio double, "
        "trade_time_ms long",
    )
    return FE.with_chunks(df, Params(chunk_rows=2))


def test_g13_g14_cooldown_strict_and_anchored_on_alerts(spark):
    got = run_sequential(_candidates(spark, [0, 30_000, 30_001, 45_000, 60_001, 60_002]), D.cooldown_rule(), 600_000)
    # 30 000 is not > 30 000; 45 000 is suppressed and does not move the anchor
    assert sorted(r.trade_id for r in got.collect()) == [1, 3, 6]


def test_g15_spike_high_and_nulls(spark):
    # trickle (counts of 1), burst A fires MEDIUM at its 3rd trade; burst C
    # starts 24 s later, its early crossings are inside the 30 s cooldown and
    # the first allowed one (8 trades in 10 s vs mean 91/60) is HIGH
    rows = [("S", i + 1, 100.0, 1.0, T0 + i * 60_000) for i in range(60)]
    b = T0 + 60 * 60_000
    rows += [("S", 100 + i, 100.0, 1.0, b + i * 10) for i in range(3)]
    rows += [("S", 200 + i, 100.0, 1.0, b + 24_000 + i * 1000) for i in range(8)]
    got = D.volume_spikes(trades(spark, rows), SMALL).orderBy("trade_id").collect()
    assert [(r.trade_id, r.severity) for r in got] == [(102, "MEDIUM"), (207, "HIGH")]
    assert got[1].volume_ratio == 8 / (91 / 60)
    assert got[1].price_start is None and got[1].price_change_pct is None and got[1].price_end == 100.0
    assert got[1].description == f"8 trades in last 10s vs avg {91 / 60:.1f} ({8 / (91 / 60):.1f}x normal — 10-min rolling baseline)"


# --------------------------------------------------------------------- pump
def pump(spark, prices, times, p=SMALL, sym="S"):
    t = trades(spark, [(sym, i + 1, float(px), 1.0, T0 + ms) for i, (px, ms) in enumerate(zip(prices, times))])
    return D.pump_and_dump(t, p).orderBy("trade_id").collect()


def test_g16_basic_pump_and_dump(spark):
    got = pump(spark, [100.0, 100.5, 100.1], [0, 60_000, 120_000])
    assert len(got) == 1
    r = got[0]
    drop = (100.5 - 100.1) / 100.5 * 100
    rise = (100.5 - 100.0) / 100.0 * 100
    assert (r.price_start, r.price_end) == (100.0, 100.1)
    assert r.price_change_pct == -drop and r.volume_ratio == rise / drop
    assert r.description == f"Pump +{rise:.2f}% to 100.50, then dump -{drop:.2f}% to 100.10 in 120s"


def test_g17_timeout_edge(spark):
    assert len(pump(spark, [100.0, 100.5, 100.1], [0, 60_000, 240_000])) == 1
    assert pump(spark, [100.0, 100.5, 100.1], [0, 60_000, 240_001]) == []


def test_g18_next_trade_after_fire_is_baseline(spark):
    # fire at trade 3; trade 4 (100.1) becomes baseline, not trade 3
    prices = [100.0, 100.5, 100.1, 100.1, 100.6, 100.2]
    got = pump(spark, prices, [i * 1000 for i in range(6)])
    assert [r.trade_id for r in got] == [3, 6]
    assert got[1].price_start == 100.1


def test_g19_severity_sum_strict(spark):
    got = pump(spark, [52.0, 52.78, 51.9883], [0, 1000, 2000])
    assert got[0].severity == "MEDIUM"  # rise + drop == 3.0 exactly
    got = pump(spark, [52.0, 53.0, 51.0], [0, 1000, 2000])
    assert got[0].severity == "HIGH"


def test_g20_silence_resets_then_next_is_baseline(spark):
    # baseline 100; 10 min later 200 resets; 100.0 is the new baseline
    prices = [100.0, 200.0, 100.0, 100.5, 100.1]
    times = [0, 600_000, 601_000, 602_000, 603_000]
    got = pump(spark, prices, times)
    assert [r.trade_id for r in got] == [5] and got[0].price_start == 100.0


def test_g21_symbols_do_not_share_state(spark):
    rows = [("A", 1, 100.0, 1.0, T0), ("B", 2, 100.0, 1.0, T0 + 1), ("A", 3, 100.5, 1.0, T0 + 2),
            ("B", 4, 99.0, 1.0, T0 + 3), ("A", 5, 100.1, 1.0, T0 + 4), ("B", 6, 98.0, 1.0, T0 + 5)]
    got = D.pump_and_dump(trades(spark, rows), SMALL).collect()
    assert [(r.symbol, r.trade_id) for r in got] == [("A", 5)]


def test_zero_price_state_falls_back_like_unset(spark):
    # a zero baseline is "unset": the current price stands in for it
    got = pump(spark, [0.0, 100.0, 101.0, 100.5], [0, 1000, 2000, 3000])
    assert [r.trade_id for r in got] == [4]
    assert got[0].price_start == 100.5  # start falls back to each row's own price


# ------------------------------------------------------------------- ingest
def test_g22_raw_message_classification(spark):
    msgs = [
        ('{"stream":"x@trade","data":{"e":"trade","s":"BTCUSDT","t":1,"p":"61777.25","q":"0.375","T":1700000001000,'
         '"m":false}}', None),
        ('{"e":"trade","s":"ETHUSDT","t":2,"p":"2000.1","q":"1.5","T":1700000001500,"m":true}', None),
        ('{"result":null,"id":1}', "not_trade"),
        ("not json at all", "not_json"),
        ('{"e":"trade","s":"X","t":3,"p":"abc","q":"1","T":1,"m":false}', "bad_number"),
        ('{"e":"trade","s":"X","t":3,"p":"1","q":"1","m":false}', "missing_field"),
        ('{"e":"trade","s":"X","t":3,"p":null,"q":"1","T":1,"m":false}', "null_field"),
        ('{"e":"trade","s":"X","t":4,"p":"1","q":"1","T":"1700000002000","m":false}', None),
    ]
    raw = spark.createDataFrame([(m,) for m, _ in msgs], "value string")
    got = {r.value: r.reason for r in I.classify_raw(raw).collect()}
    assert got == {m: reason for m, reason in msgs}
    good = {r.symbol: r for r in I.normalize_trades(raw).collect()}
    assert good["BTCUSDT"].price == 61777.25 and good["BTCUSDT"].trade_time == "2023-11-14T22:13:21+00:00"
    assert good["ETHUSDT"].trade_time == "2023-11-14T22:13:21.500000+00:00"
    assert sorted(r.reason for r in I.rejected_trades(raw).collect()) == sorted(
        r for _, r in msgs if r is not None
    )


def test_g23_routing_and_parse_roundtrip(spark):
    msgs = spark.createDataFrame(
        [("BTCUSDT", 1, 1.5, 2.0, 1_700_000_000_000, "t", False), ("NEWCOIN", 2, 3.0, 1.0, 1_700_000_000_001, "t", True)],
        "symbol string, trade_id long, price double, quantity double, trade_time_ms long, trade_time string, "
        "is_buyer_mm boolean",
    )
    routed = {r.symbol: r.partition for r in I.route_trades(msgs).collect()}
    assert routed == {"BTCUSDT": 0, "NEWCOIN": 0}
    assert {r.symbol: r.partition for r in I.route_trades(msgs.withColumn("symbol", F.lit("XRPUSDT"))).collect()} == {
        "XRPUSDT": 5
    }
    back = I.parse_trades(I.serialize_trades(msgs)).orderBy("trade_id").collect()
    assert [(r.symbol, r.price, r.quantity, r.trade_time_ms) for r in back] == [
        ("BTCUSDT", 1.5, 2.0, 1_700_000_000_000),
        ("NEWCOIN", 3.0, 1.0, 1_700_000_000_001),
    ]
    # int() truncates an unquoted float time, rejects a quoted one
    odd = spark.createDataFrame(
        [('{"symbol":"A","price":"1","quantity":"1","trade_time_ms":17.9}',),
         ('{"symbol":"B","price":"1","quantity":"1","trade_time_ms":"17.9"}',)],
        "value string",
    )
    assert [(r.symbol, r.trade_time_ms) for r in I.parse_trades(odd).collect()] == [("A", 17)]


def test_preview_line_matches_python_format(spark):
    msgs = spark.createDataFrame([("BTCUSDT", 1, 61777.125, 0.37501), ("AVERYLONGSYMBOL", 2, 1.005, 2.0)],
                                 "symbol string, trade_id long, price double, quantity double")
    got = [r.line for r in I.preview_lines(msgs).orderBy("trade_id").collect()]
    assert got == [f"[dry-run]  {s:<10}  price={p:>12,.2f}  qty={q:>12.6f}"
                   for s, p, q in [("BTCUSDT", 61777.125, 0.37501), ("AVERYLONGSYMBOL", 1.005, 2.0)]]


# ------------------------------------------------------------------ serving
def test_g26_counts_zero_row_and_bands(spark):
    alerts = D.anomaly_events(one(spark, [100.0] * 5))
    as_of = dt.datetime(2024, 1, 1, 13)
    r = SV.anomaly_counts(alerts, "S", as_of).collect()
    assert len(r) == 1 and (r[0].volume_spikes, r[0].wash_trades, r[0].pump_and_dumps) == (0, 0, 0)
    bands = SV.anomaly_count_bands(
        spark.createDataFrame([("S", 0, 1, 5)], "symbol string, volume_spikes long, wash_trades long, pump_and_dumps long")
    ).collect()
    assert {b.pattern_type: b.band for b in bands} == {"VOLUME_SPIKE": "green", "WASH_TRADE": "yellow",
                                                       "PUMP_AND_DUMP": "red"}


def test_ticker_panel_keeps_trailing_zeros_and_sizes_are_checked(spark):
    tick = spark.createDataFrame([("S", 0.12, dt.datetime(2024, 1, 1))], "symbol string, price double, updated_at timestamp_ntz")
    assert SV.ticker_panel(tick, "S", dt.datetime(2024, 1, 1)).first().ticker == "S $0.12000"
    with pytest.raises(ValueError):
        SV.candles_last_hour(tick, "S", "15min")


def test_serving_single_symbol_paths(spark):
    t = one(spark, [100.0, 100.5, 100.1] * 30, step=1000)
    alerts = D.anomaly_events(t, SMALL)
    c = C.candles(t)
    as_of = dt.datetime(2024, 1, 1, 12, 30)
    assert SV.alert_table(alerts, "S", as_of, limit=5).count() == 5
    assert SV.recent_alerts(alerts, as_of, limit=3).count() == 3
    assert SV.candles_last_hour(c, "S", "1min", as_of).count() == 2
    assert SV.volume_series(c, "S", "1min", dt.datetime(2024, 1, 1, 12, 1), as_of).count() == 1
    assert [r.symbol for r in SV.symbols(c).collect()] == ["S"]
    views = SV.register_views(spark, ohlc_candles=c, anomaly_events=alerts)
    assert {"ohlc_candles", "anomaly_events"} <= set(views)


def test_serving_queries_by_name(spark):
    from candlewick.plans import sql as Q

    t = one(spark, [100.0, 100.5, 100.1] * 30, step=1000)
    SV.register_views(spark, ohlc_candles=C.candles(t), anomaly_events=D.anomaly_events(t, SMALL),
                      price_ticker=C.price_ticker(C.candles(t)))
    as_of = dt.datetime(2024, 1, 1, 12, 30)
    counts = Q.run(spark, "anomaly_counts", symbol="S", as_of=as_of).first()
    assert counts.pump_and_dumps > 0
    assert Q.run(spark, "alert_table", symbol="S", as_of=as_of).count() == counts.pump_and_dumps + counts.wash_trades + counts.volume_spikes
    assert Q.run(spark, "candles_last_hour", symbol="S", size="1min", as_of=as_of).count() == 2
    assert Q.parameters("symbols") == []
    assert Q.run(spark, "ticker_panel", symbol="S", as_of=as_of).first().ticker.startswith("S $100.")


def test_backfill_is_idempotent_and_exact(spark, tmp):
    from candlewick.plans.backfill import backfill

    MID = Params(chunk_rows=100)  # a few chunks
    rows = [("S", i + 1, 100.0 + (i * 37 % 11) / 10, float(i % 7 + 1), T0 + i * 3_000) for i in range(400)]
    t = trades(spark, rows)
    start, end = T0 + 300_000, T0 + 900_000
    backfill(t, start, end, tmp, MID)
    backfill(t, start, end, tmp, MID)  # replay: same partitions rewritten
    got = spark.read.parquet(f"{tmp}/anomaly_events").drop("event_date")
    # the range is widened to the whole UTC day (partitions are replaced whole)
    want = D.anomaly_events(t, MID)
    cols = sorted(want.columns)
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert got.count() > 0
    assert spark.read.parquet(f"{tmp}/ohlc_candles").where("window_size = '1min'").count() == 20


def test_backfill_replaces_days_that_come_out_empty(spark, tmp):
    from candlewick.plans.backfill import backfill

    MID = Params(chunk_rows=100)
    day = 86_400_000
    rows = [("S", i + 1, 100.0 + (i * 37 % 11) / 10, float(i % 7 + 1), T0 + i * 3_000) for i in range(200)]
    later = [("S", i + 1000, p, q, ms + day) for (_, i, p, q, ms) in rows]
    backfill(trades(spark, rows + later), T0, T0 + 2 * day, tmp, MID)
    first = spark.read.parquet(f"{tmp}/anomaly_events").groupBy("event_date").count().collect()
    assert len(first) == 2
    backfill(trades(spark, later), T0, T0 + 1, tmp, MID)  # the first day's trades were withdrawn
    left = spark.read.parquet(f"{tmp}/anomaly_events").groupBy("event_date").count().collect()
    assert [r for r in first if r in left] == left and len(left) == 1
    assert spark.read.parquet(f"{tmp}/ohlc_candles").select("event_date").distinct().count() == 1


def test_numbers_follow_the_producer(spark):
    good = ["1.5", " 2 ", "1e3", "1_000.5", ".5", "5.", "-3", "inf", "NaN"]
    bad = ["1.5d", "2f", "0x1p3", "", "1__0", "_1", "1e", "abc", None]
    df = spark.createDataFrame([(x,) for x in good + bad], "x string")
    got = {r[0]: r[1] for r in df.select("x", I.number(F.col("x"))).collect()}
    assert all(got[x] == float(x) or x == "NaN" for x in good) and all(got[x] is None for x in bad)

    def raw(**d):
        import json

        return json.dumps({"stream": "s", "data": {"e": "trade", "s": "A", "t": 1, "p": "1.5", "q": "2", "T": 1700000000000, "m": True, **d}})

    lines = [raw(), raw(p="1.5d"), raw(q="2f"), raw(T=1700000000000.5), raw(T="1700000000000.5"), '{"data":null,"e":"trade"}']
    out = I.classify_raw(spark.createDataFrame([(x,) for x in lines], "value string")).select("value", "reason", "trade_time_ms").collect()
    reasons = {r.value: (r.reason, r.trade_time_ms) for r in out}
    assert reasons[lines[0]] == (None, 1700000000000) and reasons[lines[3]] == (None, 1700000000000)
    assert all(reasons[lines[i]][0] == "bad_number" for i in (1, 2, 4)) and reasons[lines[5]][0] == "not_trade"


def test_chunk_plan_has_one_successor_per_chunk(spark):
    from candlewick.operators.chunks import plan_chunks

    t = trades(spark, [("S", i, 1.0, 1.0, T0 + i * 20_000) for i in range(600)])
    plan = plan_chunks(t, Params(chunk_rows=50)).select("chunk", "chunk_start_ms", "next_chunk", "next_chunk_start_ms").distinct()
    rows = sorted(map(tuple, plan.collect()))
    assert len(rows) > 5
    for now, after in zip(rows, rows[1:]):
        assert now[2:] == after[:2]
    assert rows[-1][2:] == (None, None)


def test_symbol_universe_publish_and_last_not_null(spark, tmp):
    msgs = spark.createDataFrame(
        [("BTCUSDT", 1, 1.5, 2.0, 1_700_000_000_000, "t", False), ("DOGEUSDT", 2, 3.0, 1.0, 1_700_000_000_001, "t", True),
         ("ZZZ", 3, 3.0, 1.0, 1_700_000_000_002, "t", True)],
        "symbol string, trade_id long, price double, quantity double, trade_time_ms long, trade_time string, "
        "is_buyer_mm boolean",
    )
    kept = I.restrict_symbols(msgs, ["BTCUSDT", "DOGEUSDT"])
    I.publish_trades(I.route_trades(kept), f"{tmp}/log")
    back = spark.read.json(f"{tmp}/log")
    assert {(r.key, r.partition) for r in back.collect()} == {("BTCUSDT", 0), ("DOGEUSDT", 4)}
    ser = spark.createDataFrame([("S", 1.0, 1), ("S", None, 2), ("T", 2.0, 1)], "symbol string, v double, o long")
    assert {r.symbol: r.v for r in SV.last_not_null(ser, "v", "o").collect()} == {"S": 1.0, "T": 2.0}


def test_strict_ingest_rejects_non_positive_and_non_finite(spark):
    def msg(p, q):
        return '{"e":"trade","s":"X","t":1,"p":"%s","q":"%s","T":1700000000000,"m":false}' % (p, q)

    rows = [msg("1.5", "2"), msg("NaN", "1"), msg("1", "Infinity"), msg("0", "1"), msg("-2", "1")]
    raw = spark.createDataFrame([(m,) for m in rows], "value string")
    assert I.normalize_trades(raw).count() == 5  # Python float() accepts them all
    assert I.normalize_trades(raw, strict=True).count() == 1
    assert {r.reason for r in I.rejected_trades(raw, strict=True).collect()} == {"not_positive"}


def test_adaptive_chunk_size_splits_a_hot_symbol(spark):
    from candlewick.operators.chunks import plan_chunks

    rows = [("HOT", i, 100.0, 1.0, T0 + i * 50) for i in range(6000)] + [("COLD", 10_000 + i, 1.0, 1.0, T0 + i) for i in range(10)]
    t = trades(spark, rows)
    plan = plan_chunks(t, Params(min_chunk_rows=500))
    n = {r.symbol: r.n for r in plan.groupBy("symbol").agg(F.countDistinct("chunk").alias("n")).collect()}
    assert n["COLD"] == 1 and n["HOT"] >= 4  # 6000 rows / max(500, 6010 / (2 x 8 cores))
    # chunk starts are grain-aligned, increasing, and chain to the next chunk
    ch = plan.where("symbol = 'HOT'").select("chunk", "chunk_start_ms", "next_chunk", "next_chunk_start_ms").distinct()
    ch = sorted(ch.collect())
    for a, b in zip(ch, ch[1:]):
        assert a.next_chunk == b.chunk and a.next_chunk_start_ms == b.chunk_start_ms > a.chunk_start_ms
    assert ch[-1].next_chunk is None


def test_release_scratch_deletes_intermediates(spark, tmp):
    import os

    from candlewick.session import _SCRATCH, cut_lineage, release_scratch

    release_scratch(spark)
    df = cut_lineage(spark.range(10), "t")
    path = _SCRATCH[-1].replace("file:", "")
    assert df.count() == 10 and os.path.exists(path)
    assert release_scratch(spark) == 1 and not os.path.exists(path)


def test_burst_inside_one_grain_is_split_exactly(spark):
    from candlewick.operators.chunks import plan_chunks
    from seqloop import run

    # one symbol: a quiet hour, then 3000 trades within one minute (many in the same ms)
    rows = [("B", i + 1, 100.0 + (i % 7) / 10, 1.0, T0 + i * 60_000) for i in range(60)]
    rows += [("B", 1000 + i, 100.0 + ((i * 13) % 17) / 10, float(1 + i % 9), T0 + 3_600_000 + (i * 7) // 3) for i in range(3000)]
    t = trades(spark, rows)
    p = Params(chunk_rows=400)
    plan = plan_chunks(t, p)
    assert plan.where("_ms is not null").count() > 0  # the burst minute is split by millisecond
    assert plan.select("chunk").distinct().count() >= 7
    got = {(r.symbol, r.pattern_type, r.trade_id) for r in D.anomaly_events(t, p).collect()}
    assert got == run(rows) and len(got) > 0


def test_missing_trade_id_sorts_first_in_candles(spark):
    t = trades(spark, [("S", 5, 7.0, 1.0, T0), ("S", None, 3.0, 1.0, T0), ("S", 9, 4.0, 1.0, T0)])
    r = C.ohlc(t).first()
    assert (r.open_price, r.close_price, r.trade_count) == (3.0, 4.0, 3)
