"""Streaming sources, candle aggregation, sinks and query wiring.

Two queries read the same source (fan-out): candles (event-time windows
with a 3 s watermark, append mode) and alerts (stateful processor without
watermark). Each has its own checkpoint; sinks are idempotent per batch id,
so a micro-batch replayed after a failure leaves the tables unchanged.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from candlewick.functions.exprs import ms_to_ts, order_key
from candlewick.operators.candles import CANDLE_COLUMNS, price_ticker
from candlewick.operators.ingest import TRADE_MESSAGE_COLUMNS, classify_raw, normalize_trades, parse_trades, route_trades
from candlewick.params import DEFAULT, Params
from candlewick.streaming.detectors import stream_alerts

# ------------------------------------------------------------------ sources
# Fixed log settings: topic raw-trades, 6 partitions, 2 h retention; producer
# acks=1, linger.ms=20, batch.size=65536, compression lz4, retries 5,
# retry.backoff.ms 500.
TOPIC = "raw-trades"
PRODUCER_OPTIONS = {
    "kafka.acks": "1",
    "kafka.linger.ms": "20",
    "kafka.batch.size": "65536",
    "kafka.compression.type": "lz4",
    "kafka.retries": "5",
    "kafka.retry.backoff.ms": "500",
}


# Bounds of a micro-batch unless the caller sets others: a batch's rows of one
# symbol are sorted together by the detectors.
MAX_RECORDS, MAX_FILES = 1_000_000, 100
REJECT_REASONS = ("not_json", "not_trade", "missing_field", "null_field", "bad_number")


def kafka_source_options(
    bootstrap: str, topic: str = TOPIC, starting_offsets: str = "latest", group_id_prefix: str | None = None
) -> dict[str, str]:
    """Options for ``readStream.format('kafka')``. Offsets are tracked in the
    query checkpoint; ``startingOffsets`` only applies to the first start."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting_offsets}
    if group_id_prefix:
        opts["groupIdPrefix"] = group_id_prefix
    return opts


def read_kafka_values(spark: SparkSession, options: dict[str, str], stream: bool = True) -> DataFrame:
    """``value STRING`` from the log (needs the Kafka connector on the classpath);
    a stream takes ``MAX_RECORDS`` a micro-batch at most unless ``options`` say
    otherwise."""
    reader = spark.readStream.option("maxOffsetsPerTrigger", str(MAX_RECORDS)) if stream else spark.read
    return reader.format("kafka").options(**options).load().select(F.col("value").cast("string").alias("value"))


def read_text_values(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File twin of the log: one JSON message per line, ``MAX_FILES`` files a
    micro-batch at most by default."""
    reader = spark.readStream.schema("value STRING").option("maxFilesPerTrigger", str(max_files_per_trigger or MAX_FILES))
    return reader.text(path)


def kafka_sink_options(bootstrap: str, topic: str, checkpoint: str) -> dict[str, str]:
    """Options for ``writeStream.format('kafka')`` (rows: key, value, partition)."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, "checkpointLocation": checkpoint, **PRODUCER_OPTIONS}


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append a result relation to a relational table (per-partition connections)."""
    df.write.jdbc(url=url, table=table, mode="append", properties=properties)


def trades_from_raw(raw: DataFrame) -> DataFrame:
    """Raw exchange messages -> engine trades (works on streams), typed once:
    no JSON is written and read again on the way. Other messages are dropped
    here; ``RawIngestSink`` keeps them with a reason."""
    return engine_trades(normalize_trades(raw))


def engine_trades(messages: DataFrame) -> DataFrame:
    """Trade messages as the engine's trades."""
    columns = ["symbol", "trade_id", "price", "quantity", "trade_time_ms"]
    return messages.select(*columns, ms_to_ts("trade_time_ms").alias("event_ts"))


def observed_messages(raw: DataFrame, name: str = "ingest") -> DataFrame:
    """``classify_raw`` of a stream that counts as it goes: messages, trades and
    rejects by reason of every micro-batch, reported in the query's progress
    under ``name`` (see ``ThroughputListener``)."""
    one = F.col("reason")
    counts = [F.count(F.lit(1)).alias("messages"), F.count_if(one.isNull()).alias("trades")]
    return classify_raw(raw).observe(name, *counts, *[F.count_if(one == r).alias(r) for r in REJECT_REASONS])


# ------------------------------------------------------------------ candles
def stream_candles(trades: DataFrame, p: Params = DEFAULT, delay: str = "3 seconds") -> DataFrame:
    """Tumbling-window candles for every configured size, emitted once when
    the watermark (max event time - ``delay``) passes the window end.

    Late trades of a closed window are dropped, as in the reference. Each
    size is its own stateful aggregation (a streaming plan cannot feed one
    aggregation's output to both the sink and a roll-up), so a micro-batch
    is scanned once per size."""
    ev = trades.withColumn("_ets", F.timestamp_millis("trade_time_ms")).withWatermark("_ets", delay)
    order = order_key("trade_time_ms", "trade_id")
    parts = []
    for label, ms in p.candle_sizes:
        agg = ev.groupBy("symbol", F.window("_ets", f"{ms // 1000} seconds").alias("w")).agg(
            F.min_by("price", order).alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", order).alias("close_price"),
            F.sum("quantity").alias("trade_volume"),
            F.count(F.lit(1)).cast("int").alias("trade_count"),
        )
        parts.append(
            agg.select(
                "symbol",
                ms_to_ts(F.unix_millis("w.start")).alias("window_start"),
                ms_to_ts(F.unix_millis("w.end")).alias("window_end"),
                F.lit(label).alias("window_size"),
                *CANDLE_COLUMNS[4:],
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# -------------------------------------------------------------------- sinks
NOT_NULL = {
    "candles": ("symbol", "window_start", "window_end", "window_size", "open_price", "high_price", "low_price",
                "close_price", "trade_volume", "trade_count"),
    "alerts": ("symbol", "detected_at", "pattern_type", "severity", "description"),
}


def split_not_null(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows meeting the NOT NULL contract, the others with a reason)."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull()
    bad_reason = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(f"null:{c}")) for c in cols])
    return df.where(ok), df.where(~ok).withColumn("reason", bad_reason)


def run_of(df: DataFrame) -> str:
    """The id of the streaming query that runs this micro-batch (one per
    checkpoint), or ``direct`` outside a query."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


class RawIngestSink:
    """``foreachBatch`` sink of raw exchange messages (or of classified ones): the
    trades go to the sink ``trades``, every other message with its reason
    (``value, reason``) to ``path/run=<query>/batch_id=b``. A message is parsed
    once for both. Replaying a batch rewrites the same rows."""

    def __init__(self, path: str, trades):
        self.path, self.trades = path.rstrip("/"), trades

    def __call__(self, raw: DataFrame, batch_id: int) -> None:
        src = (raw if "reason" in raw.columns else classify_raw(raw)).persist()
        rejects = src.where(F.col("reason").isNotNull()).select("value", "reason")
        rejects.write.mode("overwrite").parquet(f"{self.path}/run={run_of(raw)}/batch_id={batch_id}")
        self.trades(engine_trades(src.where(F.col("reason").isNull())), batch_id)
        src.unpersist()


class RoutedSink:
    """``foreachBatch`` sink of the keyed, explicitly partitioned log: records
    (``key, value, partition``) of trade messages. With ``kafka`` options they
    go to the log's connector, else to its file twin, JSON lines under
    ``path/run=<query>/batch_id=b/partition=N``, where a replayed batch rewrites
    its own records."""

    def __init__(self, path: str = "", kafka: dict[str, str] | None = None, p: Params = DEFAULT):
        self.path, self.kafka, self.p = path.rstrip("/"), kafka, p

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        routed = route_trades(messages, self.p).select("key", "value", "partition")
        if self.kafka is not None:
            options = {k: v for k, v in self.kafka.items() if k != "checkpointLocation"}
            routed.write.format("kafka").options(**options).save()
            return
        out = routed.withColumn("key", F.col("key").cast("string")).write.mode("overwrite").partitionBy("partition")
        out.json(f"{self.path}/run={run_of(messages)}/batch_id={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("key string, value string, partition int").json(self.path).select("key", "value", "partition")


class BatchParquetSink:
    """Idempotent append: micro-batch ``b`` of a query is written (overwrite) to
    ``path/run=<query>/batch_id=b``, partitioned by ``partition_cols`` and
    sorted within files for min/max skipping. Replaying a batch rewrites the
    same rows; a query with a new checkpoint has a new id and overwrites
    nothing. ``key_cols`` name the natural key: ``read`` returns one row per
    key, the last written, so a replay from a new checkpoint adds no copies.

    ``not_null`` rows failing the contract go to ``path/_quarantine``;
    ``created_at`` (write time, like a column default) is added only here.
    """

    def __init__(
        self,
        path: str,
        partition_cols: Sequence[str] = ("symbol",),
        sort_cols: Sequence[str] = (),
        not_null: Sequence[str] = (),
        stamp: str | None = None,
        key_cols: Sequence[str] = (),
    ):
        self.path = path.rstrip("/")
        self.partition_cols = list(partition_cols)
        self.sort_cols = list(sort_cols)
        self.not_null = list(not_null)
        self.stamp = stamp
        self.key_cols = list(key_cols)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        # the contract split reads the batch twice: cache it unless the caller did
        own_cache = bool(self.not_null) and not df.is_cached
        src = df.persist() if own_cache else df
        good, at = src, f"run={run_of(df)}/batch_id={batch_id}"
        if self.not_null:
            good, bad = split_not_null(src, self.not_null)
            bad.write.mode("overwrite").parquet(f"{self.path}/_quarantine/{at}")
        if self.stamp:
            good = good.withColumn(self.stamp, F.current_timestamp())
        out = good.sortWithinPartitions(*self.sort_cols) if self.sort_cols else good
        out.write.mode("overwrite").partitionBy(*self.partition_cols).parquet(f"{self.path}/{at}")
        if own_cache:
            src.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.parquet(self.path)
        if self.key_cols:
            newest = [F.col(c).desc() for c in ([self.stamp] if self.stamp else []) + ["run", "batch_id"]]
            last = Window.partitionBy(*self.key_cols).orderBy(*newest)
            rows = rows.withColumn("_last", F.row_number().over(last)).where("_last = 1").drop("_last")
        return rows.drop("run", "batch_id")


class TickerUpsertSink:
    """Latest-price table kept by upsert: each call writes the next version, the
    latest of (the version before, the batch's candles) per symbol. The merge
    keeps the newest ``updated_at``, so replaying a batch, also from a new
    checkpoint, changes nothing. Only versions whose write was committed
    count; a failure to read one fails the batch.
    """

    def __init__(self, path: str, source_sizes: Sequence[str] = ("1min",), keep_versions: int = 5):
        self.path = path.rstrip("/")
        self.source_sizes = tuple(source_sizes)
        self.keep_versions = keep_versions

    def _versions(self, spark: SparkSession) -> tuple[list[int], list[int]]:
        """Committed and all version numbers, found through the store."""
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return [], []
        names = [st.getPath().getName() for st in fs.listStatus(root)]
        every = sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("version="))
        done = [v for v in every if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/version={v}/_SUCCESS"))]
        return done, every

    def _prune(self, spark: SparkSession, committed: list[int]) -> None:
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for v in committed[: -(self.keep_versions + 1)]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/version={v}"), True)

    def __call__(self, candles: DataFrame, batch_id: int) -> None:
        spark = candles.sparkSession
        new = price_ticker(candles, self.source_sizes).withColumn("_rank", F.lit(1))
        done, every = self._versions(spark)
        if done:
            new = new.unionByName(spark.read.parquet(f"{self.path}/version={done[-1]}").withColumn("_rank", F.lit(0)))
        latest = new.groupBy("symbol").agg(
            F.max_by(F.struct("price", "price_change_pct", "volume_1min", "updated_at"), F.struct("updated_at", "_rank")).alias("t")
        ).select("symbol", "t.*")
        version = every[-1] + 1 if every else 0
        latest.write.mode("overwrite").parquet(f"{self.path}/version={version}")
        self._prune(spark, [*done, version])

    def read(self, spark: SparkSession) -> DataFrame:
        done, _ = self._versions(spark)
        if not done:
            raise FileNotFoundError(f"no ticker version under {self.path}")
        return spark.read.parquet(f"{self.path}/version={done[-1]}")


# ------------------------------------------------------------------ queries
def start_candle_query(
    trades: DataFrame,
    candle_path: str,
    ticker_path: str,
    checkpoint: str,
    p: Params = DEFAULT,
    trigger: dict | None = None,
) -> StreamingQuery:
    candle_sink = BatchParquetSink(
        candle_path, ("window_size", "symbol"), ("window_start",), NOT_NULL["candles"], stamp="created_at",
        key_cols=("symbol", "window_size", "window_start"),
    )
    ticker_sink = TickerUpsertSink(ticker_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        candle_sink(batch, batch_id)
        ticker_sink(batch, batch_id)
        batch.unpersist()

    w = stream_candles(trades, p).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return w.foreachBatch(write).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def start_alert_query(
    trades: DataFrame, alert_path: str, checkpoint: str, p: Params = DEFAULT, trigger: dict | None = None
) -> StreamingQuery:
    sink = BatchParquetSink(
        alert_path, ("pattern_type",), ("symbol", "detected_at"), NOT_NULL["alerts"], stamp="created_at",
        key_cols=("symbol", "pattern_type", "detected_at", "trade_id"),
    )
    w = stream_alerts(trades, p).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return w.foreachBatch(sink).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def start_ingest_query(
    raw: DataFrame, log: RoutedSink, quarantine_path: str, checkpoint: str, trigger: dict | None = None, name: str = "ingest"
) -> StreamingQuery:
    """The producer as one query: raw messages are classified once, trades go to
    the routed log, rejects with their reason to the quarantine, and their
    counts into the query's progress."""

    def write(batch: DataFrame, batch_id: int) -> None:
        src = batch.persist()
        rejects = src.where(F.col("reason").isNotNull()).select("value", "reason")
        rejects.write.mode("overwrite").parquet(f"{quarantine_path.rstrip('/')}/run={run_of(batch)}/batch_id={batch_id}")
        log(src.where(F.col("reason").isNull()).select(*TRADE_MESSAGE_COLUMNS), batch_id)
        src.unpersist()

    w = observed_messages(raw, name).writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint)
    return w.foreachBatch(write).trigger(**(trigger or {"processingTime": "5 seconds"})).start()


class ThroughputListener(StreamingQueryListener):
    """Rows/s and batch sizes of running queries: the last ``keep`` progress
    lines and failures, running totals, and the sums of observed counts (by
    observation and name: messages, trades, rejects by reason)."""

    def __init__(self, keep: int = 1000):
        self.progress: deque[dict] = deque(maxlen=keep)
        self.terminated: deque[str] = deque(maxlen=keep)
        self.rows = 0
        self.batches = 0
        self.failures = 0
        self.counts: dict[str, Counter] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pr = event.progress
        self.rows += pr.numInputRows
        self.batches += 1
        for name, row in (pr.observedMetrics or {}).items():
            self.counts.setdefault(name, Counter()).update({k: v for k, v in row.asDict().items() if v is not None})
        self.progress.append(
            {
                "name": pr.name,
                "batch_id": pr.batchId,
                "rows": pr.numInputRows,
                "input_rows_per_sec": pr.inputRowsPerSecond,
                "processed_rows_per_sec": pr.processedRowsPerSecond,
            }
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.failures += 1
            self.terminated.append(event.exception)
