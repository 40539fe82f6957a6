"""Detectors that continue from a saved state.

``detect_from(trades, state)`` gives the alerts of ``trades`` as if all earlier
trades stood before them, and the state after them. A state is one row per
symbol and bounded, whatever the history:

* the fold states: pump baseline (``base_price, base_ms, peak_price, expired``)
  and the last spike alert (``last_alert_ms``);
* ``tail``: the trades that the next frames reach back to (one less than the
  longer frame, oldest first) with their 10 s counts;
* ``older``: trades per millisecond of the last 10 s that are not in ``tail``.

Symbols without a trade keep their state. A history cut at any times and run
piece by piece gives the alerts of one run; the same state starts the streaming
detectors (``streaming.detectors``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField

from candlewick.operators import detect as D
from candlewick.operators import features as FE
from candlewick.operators.chunks import recent_count, rolling_rows, with_frame_halo
from candlewick.operators.sequential import SequentialRule, combine_rules, fold_with_states
from candlewick.params import DEFAULT, Params
from candlewick.session import cut_lineage

FOLD_FIELDS = ["base_price", "base_ms", "peak_price", "expired", "last_alert_ms"]
TAIL = "tail array<struct<trade_id:bigint,trade_time_ms:bigint,price:double,quantity:double,recent_count:bigint>>"
STATE_SCHEMA = (
    "symbol string, base_price double, base_ms bigint, peak_price double, expired boolean, last_alert_ms bigint, "
    f"{TAIL}, older array<struct<ts:bigint,n:bigint>>"
)
_TAIL_FIELDS = ["trade_id", "trade_time_ms", "price", "quantity", "recent_count"]
#: where the combined rule keeps each fold field
_COMBINED = [*(f"pump_and_dump__{c}" for c in FOLD_FIELDS[:4]), "cooldown__last_alert_ms"]


def reach(p: Params) -> int:
    """How many trades the frames of the next trade reach back."""
    return max(p.wash_frame, p.spike_frame) - 1


def tail_rule(n: int) -> SequentialRule:
    """Emits a chunk's last ``n`` rows; has no state."""

    def step(state, rows, emit):
        if emit is not None and n:
            last = rows.iloc[-n:][_TAIL_FIELDS]
            ids = [None if x else int(i) for x, i in zip(last["trade_id"].isna(), last["trade_id"].fillna(0))]
            others = (last[c].to_numpy(k).tolist() for c, k in zip(_TAIL_FIELDS[1:], (np.int64, float, float, np.int64)))
            for r in zip(ids, *others):
                emit(r)
        return ()

    return SequentialRule(
        name="tail",
        input_cols=["price", "quantity", "recent_count"],
        state_fields=[],
        out_fields=[StructField(c, DoubleType() if c in ("price", "quantity") else LongType()) for c in _TAIL_FIELDS],
        initial=(),
        step=step,
        normalize=lambda state, first_ts: (),
        normalize_cols=lambda cols, first_ts: [],
    )


def continued_features(trades: DataFrame, state: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``features.all_features`` of ``trades``, with the trades of the state's
    ``tail`` in front (they are not returned)."""
    own = trades.select("symbol", "trade_id", "price", "quantity", "trade_time_ms", F.lit(None).cast("bigint").alias("_known"))
    ahead = state.select("symbol", F.inline("tail")).withColumnRenamed("recent_count", "_known")
    chunked = FE.with_chunks(own.unionByName(ahead), p)
    older = state.select("symbol", F.inline("older"))
    counted = recent_count(with_frame_halo(chunked), chunked, p.spike_window_ms, older=older)
    counted = counted.withColumn("recent_count", F.coalesce("_known", "recent_count"))
    f = rolling_rows(rolling_rows(counted, p.wash_frame, FE._wash_aggs), p.spike_frame, FE._spike_aggs)
    return FE._spike_derived(FE._wash_derived(FE._no_copies(f))).where("_known IS NULL").drop("_known")


def empty_state(spark) -> DataFrame:
    return spark.createDataFrame([], STATE_SCHEMA)


def detect_from(trades: DataFrame, state: DataFrame | None, end_ms: int, p: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Alerts (``detect.ANOMALY_COLUMNS``) of ``trades``, all of them before
    ``end_ms`` and behind the trades of ``state``, and the state at ``end_ms``."""
    state = empty_state(trades.sparkSession) if state is None else state
    f = cut_lineage(continued_features(trades, state, p), "features")  # read by the wash rule and every pass of the folds
    parts = [D.pump_rule(p), D.cooldown_rule(p), tail_rule(reach(p))]
    rule = combine_rules([(parts[0], None), (parts[1], "_spike_candidate"), (parts[2], None)], "resumed")
    start = state.select("symbol", *[F.col(c).alias(n) for c, n in zip(FOLD_FIELDS, _COMBINED)])
    folded, ended = fold_with_states(f.withColumn("_spike_candidate", D.spike_test(p)), rule, p.seq_halo_ms, initial=start)

    def part(i: int) -> DataFrame:
        return folded.where(F.col("_rule") == i).select("symbol", *[F.col(f"{parts[i].name}__{x.name}").alias(x.name) for x in parts[i].out_fields])

    alerts = D.wash_trades(None, p, features=f).unionByName(D._spike_alerts(part(1), p)).unionByName(D._pump_alerts(part(0), p))
    return alerts.select(*D.ANOMALY_COLUMNS), _next_state(trades, state, part(2), ended, end_ms, p)


def _next_state(trades: DataFrame, state: DataFrame, tails: DataFrame, ended: DataFrame, end_ms: int, p: Params) -> DataFrame:
    before = state.select("symbol", F.inline("tail"))
    newest = Window.partitionBy("symbol").orderBy(F.col("trade_time_ms").desc(), F.col("trade_id").desc_nulls_last())
    # some rows of each chunk; Spark keeps the best of them before the shuffle
    last = before.unionByName(tails).withColumn("_r", F.row_number().over(newest)).where(F.col("_r") <= reach(p)).drop("_r")
    ordered = F.sort_array(F.collect_list(F.struct("trade_time_ms", "trade_id", "price", "quantity", "recent_count")))
    fields = F.transform(ordered, lambda t: F.struct(*[t[c].alias(c) for c in _TAIL_FIELDS]))
    tail = last.groupBy("symbol").agg(fields.alias("tail"))
    # counts of the last window: what was known and the trades, without those in the tail
    since = F.lit(end_ms - p.spike_window_ms)
    one = F.lit(1).cast("bigint")
    counts = [
        state.select("symbol", F.inline("older")).select("symbol", "ts", "n"),
        before.select("symbol", F.col("trade_time_ms").alias("ts"), one.alias("n")),
        trades.select("symbol", F.col("trade_time_ms").alias("ts"), one.alias("n")),
        last.select("symbol", F.col("trade_time_ms").alias("ts"), (-one).alias("n")),
    ]
    per_ms = counts[0].where(F.col("ts") >= since)
    for c in counts[1:]:
        per_ms = per_ms.unionByName(c.where(F.col("ts") >= since))
    per_ms = per_ms.groupBy("symbol", "ts").agg(F.sum("n").alias("n")).where("n > 0")
    older = per_ms.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("ts", "n"))).alias("older"))  # a row per millisecond at most
    kept = state.select("symbol", F.struct(*FOLD_FIELDS).alias("_old"))
    new = ended.select("symbol", F.struct(*[F.col(n).alias(c) for c, n in zip(FOLD_FIELDS, _COMBINED)]).alias("_new"))
    folds = kept.join(new, "symbol", "full").select("symbol", F.coalesce("_new", "_old").alias("s")).select("symbol", "s.*")
    out = folds.join(tail, "symbol", "left").join(older, "symbol", "left")
    return out.withColumn("older", F.coalesce("older", F.array().cast("array<struct<ts:bigint,n:bigint>>"))).select(
        "symbol", *FOLD_FIELDS, "tail", "older"
    )
