"""Exchange-feed messages derived from the driver's ``events`` table.

The reference ingests raw exchange JSON from a socket. Here the same text
is derived from ``events`` by Spark (``to_json``), so ingest jobs grow with
the data and run on Spark:

* one exchange trade message per event, wrapped in the combined-stream
  envelope ``{"stream": ..., "data": {...}}`` except for ``view`` events,
  which use the bare single-stream form;
* one extra malformed message for every event with ``value < 2`` (the kind
  of defect depends on ``event_type``), so the quarantine path has work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.sources.tables import PRICE_DIVISOR, TIME_COMPRESSION, TIME_ORIGIN_MS
from candlewick.functions.exprs import ts_to_ms

# Fixed feed conventions: symbol = upper(event_type) || 'USDT'; a message is
# malformed when value < 2.0; the defect per event_type is
# click -> truncated text, signup -> price "n/a", purchase -> no "T" key,
# view -> subscription reply {"result":null,"id":...}, error -> price null.
BAD_VALUE_BELOW = 2.0


def _trade_fields(events: DataFrame) -> DataFrame:
    raw_ms = ts_to_ms(F.col("ts"))
    ms = (F.lit(TIME_ORIGIN_MS) + F.floor((raw_ms - F.lit(TIME_ORIGIN_MS)) / F.lit(TIME_COMPRESSION))).cast("bigint")
    price = F.lit(100.0) + F.col("value") / F.lit(PRICE_DIVISOR[False])
    qty = F.expr("try_cast(get_json_object(props, '$.k') AS DOUBLE)") + F.lit(1.0)
    return events.select(
        "event_type",
        "event_id",
        "value",
        F.concat(F.upper("event_type"), F.lit("USDT")).alias("s"),
        price.cast("string").alias("p"),
        qty.cast("string").alias("q"),
        ms.alias("T"),
        (F.pmod(F.col("user_id"), F.lit(2)) == 0).alias("m"),
    )


def _data(p: Column | None, with_t: bool = True) -> Column:
    fields = [
        F.lit("trade").alias("e"),
        F.col("s").alias("s"),
        F.col("event_id").alias("t"),
        (p if p is not None else F.col("p")).alias("p"),
        F.col("q").alias("q"),
    ]
    if with_t:
        fields.append(F.col("T").alias("T"))
    fields.append(F.col("m").alias("m"))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _wrap(data: Column) -> Column:
    return F.concat(F.lit('{"stream":"'), F.lower("s"), F.lit('@trade","data":'), data, F.lit("}"))


def raw_messages(events: DataFrame) -> DataFrame:
    """``value STRING`` exchange messages (good ones plus malformed extras)."""
    f = _trade_fields(events)
    good_data = _data(None)
    good_value = F.when(F.col("event_type") == "view", good_data).otherwise(_wrap(good_data))
    et = F.col("event_type")
    bad_value = (
        F.when(et == "click", F.substring(_wrap(good_data), 1, 40))
        .when(et == "signup", _wrap(_data(F.lit("n/a"))))
        .when(et == "purchase", _wrap(_data(None, with_t=False)))
        .when(et == "view", F.concat(F.lit('{"result":null,"id":'), F.col("event_id").cast("string"), F.lit("}")))
        .otherwise(_wrap(_data(F.lit(None).cast("string"))))
    )
    # one scan: each event yields its message, plus a malformed one when value < 2
    msgs = F.when(F.col("value") < BAD_VALUE_BELOW, F.array(good_value, bad_value)).otherwise(F.array(good_value))
    return f.select(F.explode(msgs).alias("value"))
