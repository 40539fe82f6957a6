from candlewick.sources.tables import (  # noqa: F401
    TRADE_COLUMNS,
    load_trades,
    read_table,
    trades_from_events,
)
