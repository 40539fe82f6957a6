"""Ingest: exchange JSON -> normalised trade messages -> engine trades.

All parsing is JSON functions + ``try_cast`` (JVM-side, no UDF); bad input
never raises under ANSI, it gets a reject reason instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.exprs import iso_utc_string, ms_to_ts, render
from candlewick.params import DEFAULT, PREVIEW_TEXT, Params

REQUIRED = ("s", "t", "p", "q", "T", "m")
TRADE_MESSAGE_COLUMNS = ["symbol", "trade_id", "price", "quantity", "trade_time_ms", "trade_time", "is_buyer_mm"]

_DIGITS = r"[0-9]+(?:_[0-9]+)*"
FLOAT_TEXT = rf"^\s*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?|(?i:inf|infinity|nan))\s*$"


def number(text: Column) -> Column:
    """A double from text by the producer's rules: no type suffixes or
    hexadecimals, as a plain cast would take, but underscores between digits."""
    plain = F.regexp_replace(text, "_", "")
    return F.when(F.regexp_like(text, F.lit(FLOAT_TEXT)), plain.try_cast("double"))


def classify_raw(raw: DataFrame, value_col: str = "value", strict: bool = False) -> DataFrame:
    """Parse every raw exchange message; adds the trade message columns and
    ``reason`` (NULL for a good trade, else not_json / not_trade /
    missing_field / null_field / bad_number, and with ``strict`` also
    not_positive for NaN, infinite, zero or negative price / quantity,
    which Python's ``float()`` would accept).

    Each message is parsed once into ``map<string,string>`` (map keys stay
    case-sensitive, so ``t`` and ``T`` are distinct), the envelope's
    ``data`` once more; every field is then a map lookup.
    """
    as_map = "map<string,string>"
    # Each parse is materialised through a one-row explode: predicates on its
    # output cannot be pushed below a Generate, so the optimizer cannot
    # substitute (and re-run) from_json at every reference.
    f = raw.select(value_col, F.explode(F.array(F.from_json(F.col(value_col), as_map))).alias("_w"))
    f = f.select(
        value_col,
        F.col("_w").isNotNull().alias("_json"),
        F.explode(
            # a present but null "data" is no bare trade
            F.array(
                F.from_json(
                    F.when(F.map_contains_key("_w", F.lit("data")), F.try_element_at("_w", F.lit("data"))).otherwise(F.col(value_col)),
                    as_map,
                )
            )
        ).alias("_d"),
    )
    d = F.col("_d")
    val = {k: F.try_element_at(d, F.lit(k)) for k in (*REQUIRED, "e")}
    price, qty = number(val["p"]), number(val["q"])
    # an unquoted JSON float is truncated, a quoted one rejected
    unquoted_ms = F.regexp_like(F.col(value_col), F.lit('"T"\\s*:\\s*-?[0-9]'))
    ms = F.coalesce(val["T"].try_cast("bigint"), F.when(unquoted_ms, number(val["T"]).try_cast("bigint")))
    tid = val["t"].try_cast("bigint")
    mm = val["m"].try_cast("boolean")
    missing = F.lit(False)
    for k in REQUIRED:
        missing = missing | ~F.coalesce(F.map_contains_key(d, F.lit(k)), F.lit(False))
    nulls = val["p"].isNull() | val["q"].isNull() | val["T"].isNull() | val["s"].isNull()
    bad_num = price.isNull() | qty.isNull() | ms.isNull() | tid.isNull() | mm.isNull()
    reason = (
        F.when(~F.col("_json"), F.lit("not_json"))
        .when(F.coalesce(val["e"] != F.lit("trade"), F.lit(True)), F.lit("not_trade"))
        .when(missing, F.lit("missing_field"))
        .when(nulls, F.lit("null_field"))
        .when(bad_num, F.lit("bad_number"))
    )
    if strict:
        # Spark orders NaN above +inf, so "c < inf" also rejects NaN
        finite_pos = lambda c: (c > 0) & (c < F.lit(float("inf")))
        reason = F.when(reason.isNull() & ~(finite_pos(price) & finite_pos(qty)), F.lit("not_positive")).otherwise(
            reason
        )
    return f.select(
        value_col,
        val["s"].alias("symbol"),
        tid.alias("trade_id"),
        price.alias("price"),
        qty.alias("quantity"),
        ms.alias("trade_time_ms"),
        iso_utc_string(ms).alias("trade_time"),
        mm.alias("is_buyer_mm"),
        reason.alias("reason"),
    )


def normalize_trades(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Good exchange trades as trade messages (``TRADE_MESSAGE_COLUMNS``)."""
    return classify_raw(raw, strict=strict).where(F.col("reason").isNull()).select(*TRADE_MESSAGE_COLUMNS)


def rejected_trades(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Quarantine: raw text plus the reason it was not a usable trade."""
    return classify_raw(raw, strict=strict).where(F.col("reason").isNotNull()).select("value", "reason")


def serialize_trades(messages: DataFrame) -> DataFrame:
    """Trade messages -> JSON text (``value``) keyed by symbol."""
    return messages.select(
        F.col("symbol").alias("key"),
        F.to_json(F.struct(*TRADE_MESSAGE_COLUMNS)).alias("value"),
    )


def route_trades(messages: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Log record per trade: ``key`` (symbol bytes), ``value`` (JSON),
    ``partition`` (fixed symbol -> partition table, unknown -> 0)."""
    pairs = []
    for sym, part in p.symbol_partitions:
        pairs += [F.lit(sym), F.lit(part)]
    table = F.create_map(*pairs)
    return messages.select(
        "symbol",
        "trade_id",
        F.encode(F.col("symbol"), "UTF-8").alias("key"),
        F.to_json(F.struct(*TRADE_MESSAGE_COLUMNS)).alias("value"),
        F.coalesce(F.try_element_at(table, F.col("symbol")), F.lit(0)).cast("int").alias("partition"),
    )


def restrict_symbols(df: DataFrame, symbols) -> DataFrame:
    """Keep only a configured symbol universe (a filter Catalyst pushes to the
    scan / partition pruning when the source is partitioned by symbol)."""
    return df.where(F.col("symbol").isin(list(symbols)))


def publish_trades(routed: DataFrame, path: str) -> None:
    """File twin of the keyed, explicitly partitioned log sink: JSON lines
    under ``path/partition=N`` (the Kafka sink takes ``key, value, partition``
    columns as they are)."""
    routed.select(F.col("key").cast("string").alias("key"), "value", "partition").write.mode("append").partitionBy(
        "partition"
    ).json(path)


def parse_trades(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Trade message JSON -> engine trades.

    Fields are read as text (a typed schema would null out ``"4.5"`` as a
    double) and then ``try_cast``; rows missing any field are dropped.
    """
    schema = "symbol STRING, trade_id STRING, price STRING, quantity STRING, trade_time_ms STRING"
    v = F.col(value_col)
    # int() truncates an unquoted JSON float but rejects a quoted one
    unquoted_ms = F.regexp_like(v, F.lit('"trade_time_ms"\\s*:\\s*-?[0-9]'))
    r = messages.select(unquoted_ms.alias("_unq"), F.inline(F.array(F.from_json(v, schema))))
    ms = F.coalesce(
        F.expr("try_cast(trade_time_ms AS BIGINT)"),
        F.when(F.col("_unq"), F.expr("try_cast(try_cast(trade_time_ms AS DOUBLE) AS BIGINT)")),
    )
    out = r.select(
        "symbol",
        F.expr("try_cast(trade_id AS BIGINT)").alias("trade_id"),
        number(F.col("price")).alias("price"),
        number(F.col("quantity")).alias("quantity"),
        ms.alias("trade_time_ms"),
    ).where(
        F.col("symbol").isNotNull()
        & F.col("price").isNotNull()
        & F.col("quantity").isNotNull()
        & F.col("trade_time_ms").isNotNull()
    )
    return out.withColumn("event_ts", ms_to_ts("trade_time_ms"))


def preview_lines(messages: DataFrame) -> DataFrame:
    """Console preview of each trade (the producer's dry-run line)."""
    line = render(PREVIEW_TEXT, symbol="symbol", price="price", qty="quantity")
    return messages.select("symbol", "trade_id", line.alias("line"))
