"""Scalar helpers with the reference's NULL and rounding rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dround(c: Column, n: int) -> Column:
    """``ROUND(x::numeric, n)`` as DOUBLE.

    The value goes through decimal(38,10) first, so rounding is decimal
    half-up on the printed value (1.15 → 1.2), not on the binary double.
    """
    return F.round(c.cast("decimal(38,10)"), n).cast("double")


def safe_div(a: Column, b: Column) -> Column:
    """``a / NULLIF(b, 0)`` in double; NULL instead of an ANSI divide error."""
    return a.cast("double") / F.nullif(b, F.lit(0)).cast("double")


def pct(part: Column, total: Column, digits: int = 1) -> Column:
    """``ROUND(100.0 * part / NULLIF(total, 0), digits)``."""
    return dround(F.lit(100.0) * safe_div(part, total), digits)


def avg_exact(c: Column, scale: int = 1) -> Column:
    """AVG of a decimal(p, ``scale``) as the correctly rounded DOUBLE.

    PostgreSQL averages NUMERIC exactly.  The unscaled sum is an exact
    integer, so one floating division by ``count · 10^scale`` rounds the
    exact average once.
    """
    unit = 10 ** scale
    unscaled = F.sum((c * unit).cast("long")).cast("double")
    return unscaled / F.nullif(F.count(c) * unit, F.lit(0)).cast("double")


def ntz_lit(value) -> Column:
    """TIMESTAMP_NTZ literal from a Python datetime, independent of any time zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def ntz_from_instant(ts: Column) -> Column:
    """UTC wall time of a TIMESTAMP instant as TIMESTAMP_NTZ (session-tz free)."""
    return F.timestamp_add("SECOND", F.unix_seconds(ts), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def instant_from_ntz(ts: Column) -> Column:
    """TIMESTAMP instant of a TIMESTAMP_NTZ read as UTC wall time (session-tz free)."""
    secs = (F.unix_date(F.to_date(ts)).cast("long") * 86400 + F.hour(ts) * 3600
            + F.minute(ts) * 60 + F.second(ts))
    return F.timestamp_seconds(secs)
