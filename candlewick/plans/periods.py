"""Backfill period by period from saved detector states.

Trades lie in a table partitioned by ``period`` (the start of their period in
ms). Running a period reads its own partition and the state that the period
before left (at most a frame of trades per symbol), never the history; it
writes the period's candles and alerts, and the state for the next one. All
three are partitions that are replaced whole, so a period can be run again;
whoever reruns a period runs the later ones after it (``run_periods``).

Candles are exact per period, as a period is a whole number of candles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import candles as C
from candlewick.operators.resume import detect_from
from candlewick.params import DEFAULT, Params
from candlewick.session import cut_lineage

DAY_MS = 86_400_000
TRADES_SCHEMA = (
    "symbol string, trade_id bigint, price double, quantity double, trade_time_ms bigint, event_ts timestamp_ntz, period bigint"
)


def write_trades(trades: DataFrame, path: str, period_ms: int = DAY_MS) -> None:
    """Store trades by period, sorted by symbol and time within files (their
    statistics let readers skip), a large period in several files."""
    start = (F.floor(F.col("trade_time_ms") / period_ms) * period_ms).alias("period")
    out = trades.select("symbol", "trade_id", "price", "quantity", "trade_time_ms", "event_ts", start)
    out = out.hint("rebalance", F.col("period")).sortWithinPartitions("period", "symbol", "trade_time_ms")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRADES_SCHEMA).parquet(path)


def periods_of(spark: SparkSession, path: str) -> list[int]:
    """The periods that hold trades (folder names only are read)."""
    return sorted(r[0] for r in _stored(spark, path).select("period").distinct().collect())


def trades_of(spark: SparkSession, path: str, period: int) -> DataFrame:
    return _stored(spark, path).where(F.col("period") == period)


def saved_state(spark: SparkSession, out_dir: str, period: int) -> DataFrame | None:
    """The state that ``period`` left; None if it was not run."""
    folder = f"{out_dir}/state/period={period}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.parquet(folder)


def run_period(
    spark: SparkSession, trades_path: str, out_dir: str, period: int, p: Params = DEFAULT, period_ms: int = DAY_MS, first: bool = False
) -> DataFrame:
    """Run one period; returns its alerts as written. ``first``: there is no
    earlier trade, so no earlier state is asked for."""
    if any(period_ms % ms for _, ms in p.candle_sizes):
        raise ValueError("a period must be a whole number of candles of every size")
    state = None if first else saved_state(spark, out_dir, period - period_ms)
    if state is None and not first:
        raise FileNotFoundError(f"period {period - period_ms} left no state under {out_dir}: run it first")
    trades = trades_of(spark, trades_path, period)
    alerts, after = detect_from(trades, state, period + period_ms, p)
    C.candles(trades, p=p).write.mode("overwrite").parquet(f"{out_dir}/ohlc_candles/period={period}")
    alerts.write.mode("overwrite").parquet(f"{out_dir}/anomaly_events/period={period}")
    # the next period starts from this state, so it comes last
    cut_lineage(after, "period-state").repartition("symbol").write.mode("overwrite").parquet(f"{out_dir}/state/period={period}")
    return spark.read.parquet(f"{out_dir}/anomaly_events/period={period}")


def run_periods(
    spark: SparkSession, trades_path: str, out_dir: str, start: int, end: int, p: Params = DEFAULT, period_ms: int = DAY_MS
) -> DataFrame:
    """Run the periods of ``[start, end)`` (whole periods) one after the other,
    each from the state before it; the first from none if there is no earlier
    partition of trades. Returns all alerts written under ``out_dir``."""
    earliest = min(periods_of(spark, trades_path), default=None)
    for period in range(start - start % period_ms, end, period_ms):
        run_period(spark, trades_path, out_dir, period, p, period_ms, first=earliest is None or period <= earliest)
    return spark.read.parquet(f"{out_dir}/anomaly_events").drop("period")
