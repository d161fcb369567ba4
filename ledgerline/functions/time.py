"""Time helpers.  Days are UTC days (see ``session.use_utc``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lateness_sec(received_ts: Column, event_ts: Column) -> Column:
    """Whole seconds between arrival and event, rounded half away from zero,
    clamped at 0 (an early arrival is not late)."""
    raw = F.round((F.unix_micros(received_ts) - F.unix_micros(event_ts)) / F.lit(1e6))
    return F.greatest(raw.cast("int"), F.lit(0))


def day_of(ts: Column) -> Column:
    """Calendar day of a timestamp in the session zone (UTC)."""
    return F.to_date(ts)


def ntz(ts: Column) -> Column:
    """Wall-clock (UTC) timestamp without zone, the form results are returned in."""
    return ts.cast("timestamp_ntz")


def day_number(day: Column) -> Column:
    """Days since 1970-01-01; usable in range window frames."""
    return F.unix_date(day)
