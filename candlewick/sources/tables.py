"""Reading the driver tables and adapting ``events`` into trades.

Trades are the engine's input relation:
``symbol STRING, trade_id BIGINT, price DOUBLE, quantity DOUBLE,
trade_time_ms BIGINT, event_ts TIMESTAMP_NTZ``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.exprs import ms_to_ts, ts_to_ms

TRADE_COLUMNS = ["symbol", "trade_id", "price", "quantity", "trade_time_ms", "event_ts"]

# Adapter constants (fixed values, shared with the DuckDB oracle):
# time origin 2024-01-01T00:00:00Z = 1704067200000 ms, time compressed by 50,
# price = 100 + value / 100 (primary) or 100 + value / 1000 (selective),
# quantity = props.k + 1.
TIME_ORIGIN_MS = 1704067200000
TIME_COMPRESSION = 50
PRICE_DIVISOR = {False: 100.0, True: 1000.0}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trades_from_events(events: DataFrame, selective: bool = False) -> DataFrame:
    """Map the driver's ``events`` table onto trades (see FIXTURES.md §2).

    Only five source columns are read (column pruning reaches the scan);
    rows with any missing field are dropped, as a malformed trade would be.
    """
    raw_ms = ts_to_ms(F.col("ts"))
    ms = F.lit(TIME_ORIGIN_MS) + F.floor((raw_ms - F.lit(TIME_ORIGIN_MS)) / F.lit(TIME_COMPRESSION))
    qty = F.expr("try_cast(get_json_object(props, '$.k') AS DOUBLE)") + F.lit(1.0)
    out = events.select(
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("trade_id"),
        (F.lit(100.0) + F.col("value") / F.lit(PRICE_DIVISOR[selective])).alias("price"),
        qty.alias("quantity"),
        ms.cast("bigint").alias("trade_time_ms"),
    ).where(
        F.col("symbol").isNotNull()
        & F.col("trade_id").isNotNull()
        & F.col("price").isNotNull()
        & F.col("quantity").isNotNull()
        & F.col("trade_time_ms").isNotNull()
    )
    return out.withColumn("event_ts", ms_to_ts("trade_time_ms"))


def load_trades(spark: SparkSession, sf_dir: str, selective: bool = False) -> DataFrame:
    return trades_from_events(read_table(spark, sf_dir, "events"), selective=selective)
