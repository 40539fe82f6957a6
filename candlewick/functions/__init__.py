from candlewick.functions.exprs import (  # noqa: F401
    guarded_div,
    iso_utc_string,
    ms_to_ts,
    severity,
    ts_to_ms,
)
