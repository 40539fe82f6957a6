"""Physical-plan regressions: the shapes that matter at scale."""

import datetime as dt
import re

import pytest

from candlewick.operators import candles as C
from candlewick.operators import features as FE
from candlewick.operators import ingest as I
from candlewick.plans import serving as SV
from candlewick.sources.raw import raw_messages
from candlewick.sources.tables import load_trades, read_table
from candlewick.streaming import queries as Q
from conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_candles_and_ticker_are_hash_aggregations(spark):
    t = load_trades(spark, SF_SMALL)
    for df in (C.candles(t), C.price_ticker(C.candles(t))):
        plan = plan_of(df)
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(C.ohlc(load_trades(spark, SF_SMALL)))
    assert "user_id" not in plan.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_feature_pass_is_one_exchange_one_sort(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        plan = plan_of(FE.all_features(load_trades(spark, SF_SMALL)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    full = re.findall(r"Exchange hashpartitioning\(symbol#\d+, chunk#\d+L, \d+\)", plan)
    assert len(full) == 1  # rows, copies and 10 s counts of a chunk meet once
    # one sort of the rows; the small per-millisecond halo side may add its own
    assert len(re.findall(r"Sort \[symbol#\d+ ASC NULLS FIRST, chunk#\d+L ASC NULLS FIRST, trade_time_ms", plan)) == 1


def test_features_write_no_rows(spark):
    from candlewick import session

    session.release_scratch(spark)
    FE.all_features(load_trades(spark, SF_SMALL))
    assert {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in session._SCRATCH} <= {"grains", "chunk-plan"}


def test_per_symbol_top_k_is_a_group_limit(spark):
    alerts = read_table(spark, SF_SMALL, "events").selectExpr(
        "event_type AS symbol", "event_id AS trade_id", "ts AS detected_at", "'WASH_TRADE' AS pattern_type",
        "'HIGH' AS severity", "value AS price_change_pct", "value AS volume_ratio", "'d' AS description",
    )
    assert "WindowGroupLimit" in plan_of(SV.alert_table(alerts, None, dt.datetime(2024, 2, 1), 100))


def test_ingest_is_narrow(spark):
    plan = plan_of(I.normalize_trades(raw_messages(read_table(spark, SF_SMALL, "events"))))
    assert "Exchange" not in plan


def test_kafka_options():
    src = Q.kafka_source_options("b:9092", starting_offsets="earliest", group_id_prefix="cw")
    assert src == {"kafka.bootstrap.servers": "b:9092", "subscribe": "raw-trades", "startingOffsets": "earliest",
                   "groupIdPrefix": "cw"}
    sink = Q.kafka_sink_options("b:9092", "raw-trades", "/ck")
    assert sink["kafka.acks"] == "1" and sink["kafka.compression.type"] == "lz4" and sink["checkpointLocation"] == "/ck"
