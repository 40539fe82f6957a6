"""Stream/batch parity, idempotent sinks and late-data handling."""

import glob
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.operators import candles as C
from candlewick.operators import detect as D
from candlewick.operators import ingest as I
from candlewick.params import Params
from candlewick.sources.raw import raw_messages
from candlewick.sources.tables import read_table
from candlewick.streaming import queries as Q
from candlewick.streaming.detectors import stream_alerts
from conftest import SF_SMALL

ALERT_KEY = ["symbol", "pattern_type", "trade_id"]


def _write_feed(spark, sf, path, pieces=4):
    """Raw feed as JSON-lines files in time order (one file per time slice)."""
    raw = raw_messages(read_table(spark, sf, "events"))
    trades = Q.trades_from_raw(raw).select("trade_time_ms")
    lo, hi = trades.agg(F.min("trade_time_ms"), F.max("trade_time_ms")).first()
    good = Q.trades_from_raw(raw).select(
        "trade_time_ms", F.to_json(F.struct("symbol", "trade_id", "price", "quantity", "trade_time_ms")).alias("value")
    )
    pdf = good.toPandas().sort_values("trade_time_ms")
    edges = [lo + (hi - lo + 1) * i // pieces for i in range(pieces + 1)]
    os.makedirs(path, exist_ok=True)
    for i in range(pieces):
        part = pdf[(pdf.trade_time_ms >= edges[i]) & (pdf.trade_time_ms < edges[i + 1])]
        name = f"{path}/part-{i:03d}.json"
        with open(name, "w") as fh:
            fh.write("\n".join(part["value"]) + "\n")
        _stamp(name, i)
    return pdf


def _stamp(name, i):
    """The file source takes new files in modification-time order; make it
    the time order of the slices."""
    os.utime(name, (1_700_000_000 + i, 1_700_000_000 + i))


def test_alert_stream_matches_batch(spark, tmp):
    feed = f"{tmp}/feed"
    _write_feed(spark, SF_SMALL, feed, pieces=4)
    msgs = Q.read_text_values(spark, feed, max_files_per_trigger=1)
    stream_trades = Q.parse_trades(msgs)
    sink = Q.BatchParquetSink(f"{tmp}/alerts", ("pattern_type",))
    q = (
        stream_alerts(stream_trades)
        .writeStream.option("checkpointLocation", f"{tmp}/ck")
        .foreachBatch(sink)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    streamed = sink.read(spark)
    batch_trades = Q.parse_trades(spark.read.schema("value string").text(feed))
    batch = D.anomaly_events(batch_trades)
    s = streamed.select(*D.ANOMALY_COLUMNS).toPandas().sort_values(ALERT_KEY).reset_index(drop=True)
    b = batch.toPandas().sort_values(ALERT_KEY).reset_index(drop=True)
    assert len(b) > 0 and set(b.pattern_type) == {"WASH_TRADE", "VOLUME_SPIKE", "PUMP_AND_DUMP"}
    pd.testing.assert_frame_equal(s[D.ANOMALY_COLUMNS], b[D.ANOMALY_COLUMNS], check_dtype=False)


def test_candle_stream_matches_batch_and_replay_is_idempotent(spark, tmp):
    feed = f"{tmp}/feed"
    pdf = _write_feed(spark, SF_SMALL, feed, pieces=3)
    # sentinel far in the future closes every real window
    last = int(pdf.trade_time_ms.max()) + 3_600_000
    with open(f"{feed}/part-999.json", "w") as fh:
        fh.write('{"symbol":"ZZZ","trade_id":1,"price":1.0,"quantity":1.0,"trade_time_ms":%d}\n' % last)
    _stamp(f"{feed}/part-999.json", 999)
    trades = Q.parse_trades(Q.read_text_values(spark, feed, max_files_per_trigger=1))
    listener = Q.ThroughputListener()
    spark.streams.addListener(listener)
    q = Q.start_candle_query(trades, f"{tmp}/candles", f"{tmp}/ticker", f"{tmp}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    # each candle size is its own stateful aggregation over the source, so
    # the listener sees every input row once per size
    want_rows = (len(pdf) + 1) * 2
    for _ in range(50):  # listener events arrive asynchronously
        if sum(p["rows"] for p in listener.progress) >= want_rows:
            break
        time.sleep(0.1)
    spark.streams.removeListener(listener)
    assert sum(p["rows"] for p in listener.progress) == want_rows and not listener.terminated
    sink = Q.BatchParquetSink(f"{tmp}/candles")
    got = sink.read(spark).where("symbol <> 'ZZZ'")
    want = C.candles(Q.parse_trades(spark.read.schema("value string").text(feed)).where("symbol <> 'ZZZ'"))
    key = ["symbol", "window_size", "window_start"]
    g = got.select(*C.CANDLE_COLUMNS).toPandas().sort_values(key).reset_index(drop=True)
    w = want.toPandas().sort_values(key).reset_index(drop=True)
    assert len(w) > 0
    pd.testing.assert_frame_equal(g, w, check_dtype=False)
    # ticker equals the batch ticker
    tick = Q.TickerUpsertSink(f"{tmp}/ticker").read(spark).where("symbol <> 'ZZZ'").toPandas()
    want_t = C.price_ticker(want).toPandas()
    cols = ["symbol", "price", "price_change_pct", "volume_1min", "updated_at"]
    pd.testing.assert_frame_equal(
        tick[cols].sort_values("symbol").reset_index(drop=True),
        want_t[cols].sort_values("symbol").reset_index(drop=True),
        check_dtype=False,
    )
    # replay one batch id: row sets unchanged
    before = sink.read(spark).count()
    (stored,) = glob.glob(f"{tmp}/candles/run=*/batch_id=1")
    on_disk = spark.read.parquet(stored)
    batch0 = spark.createDataFrame(on_disk.toPandas(), on_disk.schema)  # the batch as delivered again
    rows0 = batch0.count()
    again = Q.BatchParquetSink(f"{tmp}/candles", ("window_size", "symbol"), key_cols=key)
    for _ in range(2):
        again(batch0, 1)
    assert spark.read.parquet(stored).count() == rows0
    assert spark.read.parquet(f"{tmp}/candles/run=direct/batch_id=1").count() == rows0
    assert again.read(spark).count() == before  # one row per natural key


def test_new_checkpoint_overwrites_nothing(spark, tmp):
    """The same sink fed by two queries, each numbering its batches from 0."""
    sink = Q.BatchParquetSink(f"{tmp}/out", ("symbol",), key_cols=("symbol", "v"))
    for n in (1, 2):
        feed = f"{tmp}/in{n}"
        spark.createDataFrame([("A", n)], "symbol string, v int").write.parquet(feed)
        stream = spark.readStream.schema("symbol string, v int").parquet(feed)
        q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp}/ck{n}").trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(r.v for r in sink.read(spark).collect()) == [1, 2]


def test_ticker_survives_failed_reads_and_new_checkpoints(spark, tmp):
    import datetime as dt

    schema = ("symbol string, window_start timestamp_ntz, window_end timestamp_ntz, window_size string, "
              "open_price double, high_price double, low_price double, close_price double, trade_volume double, "
              "trade_count int")

    def candle(symbol, minute, close):
        end = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)
        return (symbol, end - dt.timedelta(minutes=1), end, "1min", 1.0, 2.0, 1.0, close, 3.0, 1)

    sink = Q.TickerUpsertSink(f"{tmp}/t")
    sink(spark.createDataFrame([candle("A", 1, 2.0), candle("B", 1, 7.0)], schema), 5)
    part = glob.glob(f"{tmp}/t/version=0/part-*.parquet")[0]
    data = open(part, "rb").read()
    open(part, "wb").write(b"broken")
    glob_crc = glob.glob(f"{tmp}/t/version=0/.part-*.crc")
    crc = [(p, open(p, "rb").read()) for p in glob_crc]
    with pytest.raises(Exception):
        sink(spark.createDataFrame([candle("A", 2, 3.0)], schema), 6)
    open(part, "wb").write(data)
    for p, d in crc:
        open(p, "wb").write(d)
    sink(spark.createDataFrame([candle("A", 3, 99.0)], schema), 0)  # batch ids start again
    assert {r.symbol: r.price for r in sink.read(spark).collect()} == {"A": 99.0, "B": 7.0}


def test_late_trade_dropped_by_candles_but_seen_by_detectors(spark, tmp):
    feed = f"{tmp}/late"
    os.makedirs(feed)
    base = 1_704_067_200_000

    def line(tid, ms, price=100.0):
        return '{"symbol":"L","trade_id":%d,"price":%s,"quantity":1.0,"trade_time_ms":%d}\n' % (tid, price, ms)

    files = {
        "a": line(1, base + 1_000) + line(2, base + 65_000),  # watermark becomes base + 62 s
        "b": line(3, base + 70_000),  # minute 0 is emitted at the end of this batch
        "c": line(4, base + 2_000, 101.0),  # late for the emitted window: dropped
        "d": line(5, base + 600_000),  # advance the watermark
    }
    # Spark judges late rows against the previous batch's watermark, so a
    # window closes one micro-batch later than in a per-record engine.
    for i, (n, txt) in enumerate(files.items()):
        with open(f"{feed}/{n}.json", "w") as fh:
            fh.write(txt)
        _stamp(f"{feed}/{n}.json", i)
    trades = Q.parse_trades(Q.read_text_values(spark, feed, max_files_per_trigger=1))
    q = (
        Q.stream_candles(trades, Params(candle_sizes=(("1min", 60_000),)))
        .writeStream.format("memory").queryName("late_candles").outputMode("append")
        .option("checkpointLocation", f"{tmp}/ck1").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    first = spark.sql("select * from late_candles where window_start = timestamp_ntz'2024-01-01 00:00:00'").collect()
    assert len(first) == 1 and first[0].trade_count == 1  # late trade dropped
    # detectors have no watermark: the late trade is processed
    seen = []

    def grab(df, _):
        seen.extend(df.collect())

    q2 = (
        stream_alerts(trades).writeStream.option("checkpointLocation", f"{tmp}/ck2")
        .foreachBatch(grab).trigger(availableNow=True).start()
    )
    q2.awaitTermination()
    assert q2.lastProgress is not None
    assert q2.recentProgress[2]["numInputRows"] == 1  # the late trade reached the detectors


def test_alert_stream_resumes_from_checkpoint(spark, tmp):
    """Stop after part of the feed, restart on the same checkpoint with the
    rest: per-symbol state carries over, alerts equal one uninterrupted run."""
    full = f"{tmp}/full"
    _write_feed(spark, SF_SMALL, full, pieces=4)
    live = f"{tmp}/live"
    os.makedirs(live)
    sink = Q.BatchParquetSink(f"{tmp}/alerts", ("pattern_type",))

    def run_once():
        q = (
            stream_alerts(Q.parse_trades(Q.read_text_values(spark, live, max_files_per_trigger=1)))
            .writeStream.option("checkpointLocation", f"{tmp}/ck")
            .foreachBatch(sink).trigger(availableNow=True).start()
        )
        q.awaitTermination()

    names = sorted(os.listdir(full))
    for stage in (names[:2], names[2:]):
        for i, n in enumerate(stage):
            os.link(f"{full}/{n}", f"{live}/{n}")
            _stamp(f"{live}/{n}", names.index(n))
        run_once()
    got = sink.read(spark).select(*D.ANOMALY_COLUMNS).toPandas().sort_values(ALERT_KEY).reset_index(drop=True)
    want = D.anomaly_events(Q.parse_trades(spark.read.schema("value string").text(full)))
    want = want.toPandas().sort_values(ALERT_KEY).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_ticker_upsert_keeps_latest_and_prunes_versions(spark, tmp):
    import datetime as dt

    sink = Q.TickerUpsertSink(f"{tmp}/ticker", keep_versions=2)
    schema = ("symbol string, window_start timestamp_ntz, window_end timestamp_ntz, window_size string, "
              "open_price double, high_price double, low_price double, close_price double, trade_volume double, "
              "trade_count int")
    t0 = dt.datetime(2024, 1, 1)
    for b in range(6):
        end = t0 + dt.timedelta(minutes=b + 1)
        rows = [("A", end - dt.timedelta(minutes=1), end, "1min", 1.0, 2.0, 1.0, float(b), 3.0, 1)]
        if b == 0:
            rows.append(("B", t0, t0 + dt.timedelta(minutes=1), "1min", 5.0, 5.0, 5.0, 5.0, 1.0, 1))
        sink(spark.createDataFrame(rows, schema), b)
    got = {r.symbol: r.price for r in sink.read(spark).collect()}
    assert got == {"A": 5.0, "B": 5.0}  # B untouched since batch 0 survives the upserts
    versions = sorted(n for n in os.listdir(f"{tmp}/ticker") if n.startswith("version="))
    assert versions == ["version=3", "version=4", "version=5"]


def test_raw_ingest_keeps_rejected_messages(spark, tmp):
    raw = raw_messages(read_table(spark, SF_SMALL, "events"))
    raw.select("value").unionByName(spark.createDataFrame([("no json",), ("{}",)], "value string")).coalesce(2).write.text(f"{tmp}/raw")
    values = Q.read_text_values(spark, f"{tmp}/raw", max_files_per_trigger=1)
    sink = Q.RawIngestSink(f"{tmp}/rejected", Q.BatchParquetSink(f"{tmp}/trades"))
    q = values.writeStream.option("checkpointLocation", f"{tmp}/ck_raw").foreachBatch(sink).trigger(availableNow=True).start()
    q.awaitTermination()
    lines = spark.read.text(f"{tmp}/raw")
    got = spark.read.parquet(f"{tmp}/rejected").select("value", "reason")
    want = I.rejected_trades(lines)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.where("value = 'no json'").count() == 1
    assert spark.read.parquet(f"{tmp}/trades").count() + got.count() == lines.count()


def test_ingest_query_routes_counts_and_quarantines(spark, tmp):
    """Every raw message ends in the routed log or in the quarantine; the live
    counts equal the batch counts; a replayed batch adds nothing."""
    raw = raw_messages(read_table(spark, SF_SMALL, "events"))
    raw.repartition(3).write.text(f"{tmp}/raw")
    listener = Q.ThroughputListener()
    spark.streams.addListener(listener)
    try:
        log = Q.RoutedSink(f"{tmp}/log")
        feed = Q.read_text_values(spark, f"{tmp}/raw", max_files_per_trigger=1)
        q = Q.start_ingest_query(feed, log, f"{tmp}/rejects", f"{tmp}/ck", {"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None
        want = {r[0]: r[1] for r in I.classify_raw(raw).groupBy("reason").count().collect()}
        for _ in range(100):
            if listener.counts.get("ingest", {}).get("messages", 0) >= sum(want.values()):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    got = listener.counts["ingest"]
    assert got["messages"] == sum(want.values()) and got["trades"] == want[None]
    assert {r: got[r] for r in Q.REJECT_REASONS if got[r]} == {r: n for r, n in want.items() if r}
    routed = I.route_trades(I.normalize_trades(raw)).select(F.col("key").cast("string"), "value", "partition")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(log.read(spark)) == rows(routed)
    rejects = spark.read.parquet(f"{tmp}/rejects").select("value", "reason")
    assert rows(rejects) == rows(I.rejected_trades(raw))
    some = I.normalize_trades(raw).limit(5).persist()
    log(some, 999)
    log(some, 999)
    assert log.read(spark).count() == routed.count() + 5


def test_typed_trades_equal_the_parsed_log(spark):
    raw = raw_messages(read_table(spark, SF_SMALL, "events"))
    parsed = I.parse_trades(I.serialize_trades(I.normalize_trades(raw)))
    direct = Q.trades_from_raw(raw)
    assert direct.columns == parsed.columns
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, parsed.collect()))
    assert "to_json" not in direct._jdf.queryExecution().optimizedPlan().toString()
