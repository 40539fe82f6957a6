"""Rounds of the chunk-parallel folds."""

import logging

import pytest
from pyspark.sql import functions as F

from candlewick.operators import detect as D
from candlewick.operators import sequential as S
from candlewick.params import Params


def slow_rise(spark):
    """One baseline that 40 chunks of 5 trades never leave, then a dump."""
    prices = [100.0] + [100.0 + i / 1000 for i in range(1, 199)] + [1.0 * 101, 100.0]
    t = spark.createDataFrame([("X", i, p, 1.0, 1_700_000_000_000 + 50 * i) for i, p in enumerate(prices)],
                              "symbol string, trade_id bigint, price double, quantity double, trade_time_ms bigint")
    return t.withColumn("event_ts", F.timestamp_millis("trade_time_ms").cast("timestamp_ntz"))


@pytest.mark.parametrize(("block", "rounds"), [(S.BLOCK_ROWS, 1), (20, 4)])
def test_a_wrong_state_is_carried_through_many_chunks_in_few_rounds(spark, monkeypatch, caplog, block, rounds):
    monkeypatch.setattr(S, "BLOCK_ROWS", block)
    t = slow_rise(spark)
    with caplog.at_level(logging.INFO, "candlewick.sequential"):
        got = D.pump_and_dump(t, Params(chunk_rows=5, seq_halo_ms=0)).collect()
    assert 1 <= sum("re-folds" in r.getMessage() for r in caplog.records) <= rounds
    assert len(got) == 1 and got == D.pump_and_dump(t).collect()


def test_repeated_trades_fold_in_the_order_of_their_counts(spark):
    """Equal time and id: the one seen first has the smaller count."""
    rows = [("X", 0, None, None, 1000, 1, 1.0, n, 1.0, float(n)) for n in (5, 3, 4)]
    t = spark.createDataFrame(rows, "symbol string, chunk bigint, next_chunk bigint, next_chunk_start_ms bigint, trade_time_ms bigint, "
                              "trade_id bigint, price double, recent_count bigint, avg_count double, spike_ratio double")
    t = t.withColumn("trade_time_ms", F.col("trade_time_ms") + 1_700_000_000_000)
    assert [r["recent_count"] for r in S.run_sequential(t, D.cooldown_rule(), 0).collect()] == [3]
