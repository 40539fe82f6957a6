"""Batch backfill: the same transforms over a time range, written as result
tables partitioned by (symbol, event_date). Replaying a range replaces every
partition of its days, those that come out empty included."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.exprs import ms_to_ts
from candlewick.operators import candles as C
from candlewick.operators import detect as D
from candlewick.params import DEFAULT, Params
from candlewick.session import cut_lineage

DAY_MS = 86_400_000


def drop_days(spark, path: str, partitions: int, start_ms: int, end_ms: int) -> int:
    """Delete the ``event_date`` partitions of ``[start_ms, end_ms)`` below
    ``path`` (``partitions`` folder levels above the date), in whatever store
    it lies. Returns how many there were."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs, gone = root.getFileSystem(conf), 0
    for ms in range(start_ms, end_ms, DAY_MS):
        day = datetime.datetime.fromtimestamp(ms / 1000, datetime.timezone.utc).date()
        pattern = "/".join([path.rstrip("/"), *["*=*"] * partitions, f"event_date={day}"])
        for found in fs.globStatus(jvm.org.apache.hadoop.fs.Path(pattern)) or []:
            fs.delete(found.getPath(), True)
            gone += 1
    return gone


def write_partitioned(
    df: DataFrame,
    path: str,
    time_col: str,
    extra_partitions: tuple[str, ...] = (),
    days: tuple[int, int] | None = None,
) -> None:
    """Write a result relation partitioned by ``(*extra, symbol, event_date)``
    and sorted by time within files. ``days`` (start and end in ms, whole UTC
    days) are replaced whole: the result is computed and stored first, then
    their old partitions go, also those for which ``df`` has no row. Without
    ``days`` only the partitions present in ``df`` are replaced.

    Rows are dealt by a rebalance, which splits a large (symbol, day) over
    several files.
    """
    columns = [*extra_partitions, "symbol", "event_date"]
    out = df.withColumn("event_date", F.to_date(F.col(time_col)))
    if days is not None:
        out = cut_lineage(out, "backfill")
        drop_days(df.sparkSession, path, len(columns) - 1, *days)
    (
        out.hint("rebalance", *[F.col(c) for c in columns])
        .sortWithinPartitions(*columns, time_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def backfill(trades: DataFrame, start_ms: int, end_ms: int, out_dir: str, p: Params = DEFAULT) -> None:
    """Recompute candles and alerts for ``[start_ms, end_ms)`` widened to whole
    UTC days: output partitions are (symbol, day) and are replaced whole, so a
    partial day would drop that day's other rows (and cut boundary candles).

    Detectors need history before ``start_ms`` (59 trades for the frames, the
    running state for the sequential rules): all trades before ``end_ms`` are
    read, which is exact and chunk-parallel.
    """
    start_ms = start_ms - start_ms % DAY_MS
    end_ms = end_ms + (-end_ms) % DAY_MS
    hist = trades.where(F.col("trade_time_ms") < end_ms)
    in_range = hist.where(F.col("trade_time_ms") >= start_ms)
    candles = C.candles(in_range, p=p)
    alerts = D.anomaly_events(hist, p).where(
        (F.col("detected_at") >= ms_to_ts(F.lit(start_ms))) & (F.col("detected_at") < ms_to_ts(F.lit(end_ms)))
    )
    days = (start_ms, end_ms)
    write_partitioned(candles, f"{out_dir}/ohlc_candles", "window_start", ("window_size",), days)
    write_partitioned(alerts, f"{out_dir}/anomaly_events", "detected_at", ("pattern_type",), days)
