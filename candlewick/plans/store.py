"""Result tables laid out for serving.

``build`` writes candles, alerts and tickers as catalog tables, bucketed by
symbol, partitioned by date (candles also by size) and sorted by time within
files, so a serving query reads the partitions of its hours and, for one
symbol, one bucket; row groups outside its time range are skipped by their
statistics. ``Store`` answers the serving queries (``plans.serving``) from
them: the time filters are also given as partition filters.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import candles as C
from candlewick.operators import detect as D
from candlewick.params import DEFAULT, Params
from candlewick.plans import serving as SV
from candlewick.session import cut_lineage

BUCKETS = 8
#: table -> (partition columns, time column)
LAYOUT = {
    "ohlc_candles": (("window_size", "event_date"), "window_start"),
    "anomaly_events": (("event_date",), "detected_at"),
    "price_ticker": ((), "updated_at"),
}


def write_table(df: DataFrame, name: str, path: str, table: str, buckets: int = BUCKETS) -> None:
    """``df`` as catalog table ``name`` at ``path`` in the layout of ``table``."""
    parts, time = LAYOUT[table]
    if "event_date" in parts:
        df = df.withColumn("event_date", F.to_date(time))
    # rows of a bucket meet before the write: a file per bucket and partition
    spread = df.repartition(buckets, "symbol").sortWithinPartitions(*parts, "symbol", time)
    w = spread.write.mode("overwrite").option("path", f"{path}/{table}").bucketBy(buckets, "symbol").sortBy("symbol", time)
    (w.partitionBy(*parts) if parts else w).saveAsTable(name)


class Store:
    """Serving queries over stored tables. ``as_of`` is the time of the newest
    trade when they were built; it is the default of every query."""

    def __init__(self, spark: SparkSession, prefix: str, root: str, as_of: dt.datetime | None):
        self.spark, self.prefix, self.root, self.as_of = spark, prefix, root, as_of

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.prefix}_{name}")

    def recent(self, name: str, since: dt.datetime, until: dt.datetime | None = None) -> DataFrame:
        """The rows of the dates from ``since`` on (to ``until``)."""
        rows = self.table(name).where(F.col("event_date") >= F.lit(since.date()))
        return rows if until is None else rows.where(F.col("event_date") <= F.lit(until.date()))

    def _hour(self, name: str, as_of: dt.datetime | None) -> tuple[DataFrame, dt.datetime]:
        at = as_of or self.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        return self.recent(name, at - dt.timedelta(hours=1)), at

    def ticker_panel(self, symbol: str | None = None) -> DataFrame:
        return SV.ticker_panel(self.table("price_ticker"), symbol, self.as_of)

    def ticker_snapshot(self) -> DataFrame:
        return SV.ticker_snapshot(self.table("price_ticker"))

    def candles_last_hour(self, symbol: str | None = None, size: str = "1min", as_of: dt.datetime | None = None) -> DataFrame:
        rows, at = self._hour("ohlc_candles", as_of)
        return SV.candles_last_hour(rows, symbol, size, at)

    def volume_series(self, symbol: str | None = None, size: str = "1min", time_from=None, time_to=None) -> DataFrame:
        to = time_to or self.as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        begin = time_from or to - dt.timedelta(hours=1)
        return SV.volume_series(self.recent("ohlc_candles", begin, to), symbol, size, begin, to)

    def symbols(self) -> DataFrame:
        """From the tickers: one row per symbol that has a candle."""
        return SV.symbols(self.table("price_ticker"))

    def latest_candles(self, limit: int = 10) -> DataFrame:
        """Newest candles over all dates; the newest dates are read first, further back only while there are too few."""
        days = [r[0] for r in self.table("ohlc_candles").select("event_date").distinct().orderBy(F.col("event_date").desc()).limit(limit).collect()]
        for n in range(1, len(days) + 1):
            # a candle may end on the day after its own, so one more date is read
            rows = self.table("ohlc_candles").where(F.col("event_date") >= F.lit(days[min(n, len(days) - 1)]))
            if n == len(days) or rows.limit(limit).count() == limit:
                return SV.latest_candles(rows, limit)
        return SV.latest_candles(self.table("ohlc_candles"), limit)

    def anomaly_counts(self, symbol: str | None = None, as_of: dt.datetime | None = None) -> DataFrame:
        """Counts of the last hour; without a symbol one row for every symbol
        of the tickers, zeros where nothing fired."""
        rows, at = self._hour("anomaly_events", as_of)
        known = None if symbol else self.table("price_ticker").select("symbol")
        return SV.anomaly_counts(rows, symbol, at, known)

    def anomaly_count_bands(self, as_of: dt.datetime | None = None) -> DataFrame:
        return SV.anomaly_count_bands(self.anomaly_counts(None, as_of))

    def alert_table(self, symbol: str | None = None, as_of: dt.datetime | None = None, limit: int = 100, with_description: bool = True) -> DataFrame:
        rows, at = self._hour("anomaly_events", as_of)
        return SV.alert_table(rows, symbol, at, limit, with_description)

    def recent_alerts(self, as_of: dt.datetime | None = None, limit: int = 20) -> DataFrame:
        rows, at = self._hour("anomaly_events", as_of)
        return SV.recent_alerts(rows, at, limit)

    def drop(self) -> None:
        """Forget the tables and delete their files."""
        for name in LAYOUT:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.prefix}_{name}")
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def build(trades: DataFrame, root: str, p: Params = DEFAULT, buckets: int = BUCKETS) -> Store:
    """Compute the result relations of ``trades`` once and store them under ``root``."""
    spark, prefix = trades.sparkSession, f"candlewick_{uuid.uuid4().hex[:12]}"
    trades = cut_lineage(trades, "store-trades")  # each step reads them again: parsed once
    write_table(C.candles(trades, p=p), f"{prefix}_ohlc_candles", root, "ohlc_candles", buckets)
    write_table(D.anomaly_events(trades, p), f"{prefix}_anomaly_events", root, "anomaly_events", buckets)
    stored = spark.table(f"{prefix}_ohlc_candles").drop("event_date")
    write_table(C.price_ticker(stored), f"{prefix}_price_ticker", root, "price_ticker", buckets)
    return Store(spark, prefix, root, trades.agg(F.max("event_ts")).first()[0])
