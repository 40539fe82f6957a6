"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ms_to_ts(ms: Column | str) -> Column:
    """Epoch milliseconds -> UTC wall-clock timestamp (TIMESTAMP_NTZ).

    Independent of the session time zone, so results hash the same in any
    session and compare directly with DuckDB's naive TIMESTAMP.
    """
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH))


def ts_to_ms(ts: Column | str) -> Column:
    """TIMESTAMP / TIMESTAMP_NTZ -> epoch milliseconds (truncating microseconds)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), ts)


def guarded_div(num: Column, den: Column) -> Column:
    """``num / den`` when ``den > 0`` else 0.0 (never raises under ANSI)."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def pct_of(delta: Column, base: Column) -> Column:
    """``delta / base * 100`` when ``base > 0`` else 0.0."""
    return F.when(base > 0, delta / base * 100).otherwise(F.lit(0.0))


def severity(value: Column, cutoff: float) -> Column:
    """HIGH strictly above the cut-off, MEDIUM otherwise."""
    return F.when(value > F.lit(cutoff), F.lit("HIGH")).otherwise(F.lit("MEDIUM"))


def iso_utc_string(ms: Column) -> Column:
    """Epoch ms -> ISO-8601 text as Python's ``datetime.isoformat()`` prints it
    for an aware UTC datetime: fraction only when non-zero, six digits, and
    a ``+00:00`` offset."""
    ts = ms_to_ts(ms)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, ".SSSSSS")
    return F.concat(whole, F.when(F.pmod(ms, F.lit(1000)) == 0, F.lit("")).otherwise(frac), F.lit("+00:00"))


def py_fixed(x: Column | str, digits: int) -> Column:
    """Python ``f"{x:.Nf}"``: rounds the exact binary value half-to-even.

    ``format_string('%.2f')`` rounds the shortest decimal half-up instead
    (1.005 -> 1.01 where Python prints 1.00), so use ``format_number`` and
    drop its grouping commas.
    """
    x = F.col(x) if isinstance(x, str) else x
    return F.regexp_replace(F.format_number(x, digits), ",", "")


def py_grouped(x: Column | str, digits: int) -> Column:
    """Python ``f"{x:,.Nf}"`` (thousands separators)."""
    x = F.col(x) if isinstance(x, str) else x
    return F.format_number(x, digits)


def py_align(text: Column, width: int, left: bool) -> Column:
    """Python ``:<N`` / ``:>N`` padding (never truncates, unlike rpad/lpad)."""
    padded = F.rpad(text, width, " ") if left else F.lpad(text, width, " ")
    return F.when(F.length(text) >= width, text).otherwise(padded)


def order_key(ts: Column | str, tie: Column | str) -> Column:
    """Single ``DECIMAL(38,0)`` ordering ``(ts, tie)`` lexicographically:
    ``ts * 2^64 + (tie + 2^63)``, exact for any long ``tie`` and |ts| < 10^19.

    ``min_by/max_by`` over a struct key has a non-fixed-width buffer, which
    forces a sort-based aggregate (a full sort of the input); a decimal key
    keeps the aggregation hash-based and partial.
    """
    from decimal import Decimal

    ts = F.col(ts) if isinstance(ts, str) else ts
    tie = F.col(tie) if isinstance(tie, str) else tie
    d = "decimal(38,0)"
    # a missing tie-break sorts first, as NULLs do in Spark's ascending windows
    tie = F.coalesce(tie.cast(d), F.lit(Decimal(-(2**63))).cast(d))
    return ts.cast(d) * F.lit(Decimal(2**64)).cast(d) + (tie + F.lit(Decimal(2**63)).cast(d))


_FIELD = re.compile(r"\{(\w+)(?::([<>])?(\d+)?(,)?(?:\.(\d+)f)?)?\}")


def render(template: str, **cols: Column | str) -> Column:
    """A Python format string (``{name}``, ``{name:.2f}``, ``{name:>12,.2f}``,
    ``{name:<10}``) as one string column, formatted exactly as Python would."""
    parts: list[Column] = []
    pos = 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos : m.start()]))
        name, align, width, comma, prec = m.groups()
        c = cols[name]
        c = F.col(c) if isinstance(c, str) else c
        if prec is not None:
            c = py_grouped(c, int(prec)) if comma else py_fixed(c, int(prec))
        else:
            c = c.cast("string")
        if width:
            c = py_align(c, int(width), left=align == "<")
        parts.append(c)
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)
