"""Time helpers. Mart timestamps are TIMESTAMP_NTZ holding UTC wall-clock
time, so results do not depend on the session or JVM time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F



def EPOCH_NTZ() -> Column:  # noqa: N802 - reads as a constant
    """1970-01-01 00:00:00 as TIMESTAMP_NTZ."""
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def ntz_literal(value) -> Column:
    """A python datetime (naive, UTC) or ISO text as a TIMESTAMP_NTZ literal.

    Built from text so the python process time zone never shifts it.
    """
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def seconds_to_ntz(col: Column | str) -> Column:
    """Whole unix seconds -> UTC TIMESTAMP_NTZ."""
    return F.timestamp_add("SECOND", _c(col), EPOCH_NTZ())


def micros_to_ntz(col: Column | str) -> Column:
    return F.timestamp_add("MICROSECOND", _c(col), EPOCH_NTZ())


def ntz_to_seconds(col: Column | str) -> Column:
    return F.timestamp_diff("SECOND", EPOCH_NTZ(), _c(col))


def instant_to_ntz(col: Column | str) -> Column:
    """TIMESTAMP (an instant) -> its UTC wall-clock TIMESTAMP_NTZ."""
    return micros_to_ntz(F.unix_micros(_c(col)))


def ntz_to_instant(col: Column | str) -> Column:
    """UTC wall-clock TIMESTAMP_NTZ -> TIMESTAMP (needed for watermarks)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", EPOCH_NTZ(), _c(col)))


def start_of_hour(col: Column | str) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour, staying NTZ."""
    secs = ntz_to_seconds(_c(col))
    return seconds_to_ntz(F.floor(secs / 3600) * 3600)
