"""Serving from stored tables: what is read, and the answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick.operators import candles as C
from candlewick.operators import detect as D
from candlewick.plans import serving as SV
from candlewick.plans import store as ST
from candlewick.sources.tables import load_trades
from conftest import SF_SMALL

DAY = 86_400_000


@pytest.fixture(scope="module")
def trades(spark):
    """Three days of trades, one symbol on the first day only."""
    t = load_trades(spark, SF_SMALL)
    days = [t.withColumn("trade_time_ms", F.col("trade_time_ms") + k * DAY).withColumn("event_ts", F.col("event_ts") + F.expr(f"INTERVAL {k} DAY")) for k in range(3)]
    quiet = F.col("symbol") != "view"
    return days[0].unionByName(days[1].where(quiet)).unionByName(days[2].where(quiet))


@pytest.fixture(scope="module")
def store(spark, trades, tmp_path_factory):
    s = ST.build(trades, str(tmp_path_factory.mktemp("store")))
    yield s
    s.drop()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_hours_read_their_dates_and_a_symbol_its_bucket(spark, store):
    # plans name buckets only while the planner may not turn bucketed reads off
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        _check_plans(store)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def _check_plans(store):
    for df in (store.candles_last_hour("click"), store.alert_table("click"), store.anomaly_counts("click"), store.volume_series("click")):
        plan = plan_of(df)
        assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert f"SelectedBucketsCount: 1 out of {ST.BUCKETS}" in plan
        assert "PushedFilters" in plan and "GreaterThanOrEqual(" in plan
    everything = plan_of(store.recent_alerts())
    assert "event_date" in everything.split("PartitionFilters: [")[1].split("]")[0]


def test_answers_equal_those_over_all_results(spark, store, trades):
    candles, alerts = C.candles(trades), D.anomaly_events(trades)
    at = store.as_of
    assert at == trades.agg(F.max("event_ts")).first()[0]
    six = dt.timedelta(hours=6)
    pairs = [
        (store.candles_last_hour(None, "5min"), SV.candles_last_hour(candles, None, "5min", at)),
        (store.volume_series("click", "1min", at - six, at), SV.volume_series(candles, "click", "1min", at - six, at)),
        (store.alert_table(None, None, 7), SV.alert_table(alerts, None, at, 7)),
        (store.recent_alerts(), SV.recent_alerts(alerts, at)),
        (store.latest_candles(), SV.latest_candles(candles)),
        (store.symbols(), SV.symbols(candles)),
        (store.ticker_snapshot(), SV.ticker_snapshot(C.price_ticker(candles))),
        (store.anomaly_counts("click"), SV.anomaly_counts(alerts, "click", at)),
    ]
    for got, want in pairs:
        assert got.columns == want.columns and rows(got) == rows(want) and rows(got)


def test_counts_have_a_row_for_every_symbol(store):
    """A symbol without an alert in its hour, and one that fell silent."""
    got = {r["symbol"]: r.asDict() for r in store.anomaly_counts().collect()}
    assert set(got) == {"click", "view", "purchase", "signup", "error"}
    assert got["view"] == {"symbol": "view", "volume_spikes": 0, "wash_trades": 0, "pump_and_dumps": 0}
    bands = {r["band"] for r in store.anomaly_count_bands().where("symbol = 'view'").collect()}
    assert bands == {"green"}


def test_display_names(store):
    shown = SV.alert_display(store.alert_table())
    assert "vol_ratio (×avg)" in shown.columns
    assert all(r[0] is None or r[0].endswith("%") for r in shown.select("price_change_pct").collect())
