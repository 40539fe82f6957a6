"""The serving queries by name, over the stored result tables.

``run(spark, name, **parameters)`` reads the temp views ``ohlc_candles``,
``anomaly_events`` and ``price_ticker`` (see ``serving.register_views``) and
applies the serving function of that name; parameters are its keyword
arguments.
"""

from __future__ import annotations

import inspect

from pyspark.sql import DataFrame, SparkSession

from candlewick.plans import serving

#: name -> (the view it reads, the serving function)
NAMED = {
    "ticker_panel": ("price_ticker", serving.ticker_panel),
    "candles_last_hour": ("ohlc_candles", serving.candles_last_hour),
    "volume_series": ("ohlc_candles", serving.volume_series),
    "anomaly_counts": ("anomaly_events", serving.anomaly_counts),
    "alert_table": ("anomaly_events", serving.alert_table),
    "symbols": ("ohlc_candles", serving.symbols),
}


def parameters(name: str) -> list[str]:
    """The parameters a named query takes."""
    return list(inspect.signature(NAMED[name][1]).parameters)[1:]


def run(spark: SparkSession, name: str, **args) -> DataFrame:
    view, query = NAMED[name]
    return query(spark.table(view), **args)
