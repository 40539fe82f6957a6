"""Detectors that continue from saved states: period by period, and on a stream."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from candlewick.operators import candles as C
from candlewick.operators import detect as D
from candlewick.operators import resume as R
from candlewick.params import Params
from candlewick.plans import periods as PD
from candlewick.sources.tables import load_trades
from conftest import SF_SMALL

T0 = 1_704_067_200_000
PERIODS = int(os.environ.get("CANDLEWICK_TEST_PERIODS", "3"))  # 30 in a long run
HOUR = 3_600_000
COLS = sorted(D.ANOMALY_COLUMNS)


def rows_of(df, cols=COLS):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def random_trades(spark, seed, n, span, symbols=("A", "B", "C")):
    """Trades with bursts (many in one millisecond), silences and a symbol that
    trades early and late only."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        sym = rng.choice(symbols)
        at = rng.choice([rng.randrange(span), span // 2 - rng.randrange(8_000), span // 2 + rng.randrange(8_000), span // 3])
        if sym == "C" and span // 4 < at < 3 * span // 4:
            continue
        rows.append((sym, i, 100.0 + rng.randrange(60) / 20, float(rng.randrange(1, 9)), T0 + at))
    df = spark.createDataFrame(rows, "symbol string, trade_id long, price double, quantity double, trade_time_ms long")
    return df.withColumn("event_ts", F.timestamp_millis("trade_time_ms").cast("timestamp_ntz"))


def test_recent_counts_continue_from_older_counts(spark):
    t = random_trades(spark, 3, 900, 60_000, ("A",))
    p = Params(chunk_rows=40)
    whole = {r[0]: r[1] for r in D.spike_features(t, p).select("trade_id", "recent_count").collect()}
    for cut in (T0 + 30_001,):
        _, state = R.detect_from(t.where(F.col("trade_time_ms") < cut), None, cut, p)
        state = spark.createDataFrame(state.collect(), R.STATE_SCHEMA)
        rest = R.continued_features(t.where(F.col("trade_time_ms") >= cut), state, p)
        got = {r[0]: r[1] for r in rest.select("trade_id", "recent_count").collect()}
        assert got and all(whole[i] == n for i, n in got.items())
        held = state.first()
        assert len(held["tail"]) == 59 and all(x["n"] > 0 and x["ts"] >= cut - 10_000 for x in held["older"])


@pytest.mark.parametrize("p", [Params(chunk_rows=120)])
def test_pieces_equal_one_run(spark, p):
    """A cut in a burst."""
    span = 2 * HOUR
    t = random_trades(spark, 5, 500, span)
    want = rows_of(D.anomaly_events(t, p))
    cuts = [T0 + span // 2, T0 + span]
    state, got, begin = None, [], T0
    for cut in cuts:
        piece = t.where((F.col("trade_time_ms") >= begin) & (F.col("trade_time_ms") < cut))
        alerts, state = R.detect_from(piece, state, cut, p)
        got += rows_of(alerts)
        state, begin = spark.createDataFrame(state.collect(), R.STATE_SCHEMA), cut
    assert sorted(got, key=repr) == want and len({r[COLS.index("pattern_type")] for r in want}) == 3


def test_periods_one_by_one(spark, tmp):
    p, step = Params(), 10 * 60_000
    t = random_trades(spark, 7, 1500, PERIODS * step)
    PD.write_trades(t, f"{tmp}/trades", step)
    plan = PD.trades_of(spark, f"{tmp}/trades", T0 + step)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and f"= {T0 + step})" in plan  # one period is read
    got = PD.run_periods(spark, f"{tmp}/trades", f"{tmp}/out", T0, T0 + PERIODS * step, p, step)
    assert rows_of(got) == rows_of(D.anomaly_events(t, p)) and got.count() > 100
    cols = C.CANDLE_COLUMNS
    stored = spark.read.parquet(f"{tmp}/out/ohlc_candles")
    assert rows_of(stored, cols) == rows_of(C.candles(t, p=p), cols)
    sizes = spark.read.parquet(f"{tmp}/out/state").select(F.max(F.size("tail"))).first()[0]
    assert sizes == R.reach(p)
    # running the last periods again changes nothing; a period without a state before it is refused
    again = PD.run_periods(spark, f"{tmp}/trades", f"{tmp}/out", T0 + (PERIODS - 1) * step, T0 + PERIODS * step, p, step)
    assert rows_of(again) == rows_of(D.anomaly_events(t, p))
    with pytest.raises(FileNotFoundError):
        PD.run_period(spark, f"{tmp}/trades", f"{tmp}/none", T0 + 2 * step, p, step)


def test_batch_until_noon_and_stream_after_it(spark, tmp):
    """The stream starts from the state of the batch and gives the rest of its alerts."""
    from candlewick.streaming import queries as Q
    from candlewick.streaming.detectors import stream_alerts

    t = load_trades(spark, SF_SMALL)
    noon = T0 + 6 * HOUR
    early, late = t.where(F.col("trade_time_ms") < noon), t.where(F.col("trade_time_ms") >= noon)
    alerts, state = R.detect_from(early, None, noon)
    state.write.parquet(f"{tmp}/state")
    os.makedirs(f"{tmp}/feed")
    rows = sorted(map(tuple, late.select("trade_time_ms", "trade_id", "symbol", "price", "quantity").collect()))
    for i in range(3):
        some = rows[len(rows) * i // 3 : len(rows) * (i + 1) // 3]
        with open(f"{tmp}/feed/{i}.json", "w") as f:
            f.writelines(json.dumps(dict(zip(("trade_time_ms", "trade_id", "symbol", "price", "quantity"), r))) + "\n" for r in some)
        os.utime(f"{tmp}/feed/{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    feed = Q.parse_trades(Q.read_text_values(spark, f"{tmp}/feed", max_files_per_trigger=1))
    out = stream_alerts(feed, initial=spark.read.parquet(f"{tmp}/state"))
    q = out.writeStream.option("checkpointLocation", f"{tmp}/ck").foreachBatch(Q.BatchParquetSink(f"{tmp}/alerts", ("pattern_type",)))
    q.trigger(availableNow=True).start().awaitTermination()
    streamed = spark.read.parquet(f"{tmp}/alerts")
    key = ["symbol", "pattern_type", "trade_id", "price_start", "price_end", "price_change_pct", "volume_ratio", "description"]
    want = rows_of(D.anomaly_events(t), key)
    assert sorted(rows_of(alerts, key) + rows_of(streamed, key), key=repr) == want
    assert streamed.count() > 20 and alerts.count() > 20
