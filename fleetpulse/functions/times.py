"""Epoch conversions and the injected clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

Clock = datetime | Column | None


def event_time(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp, keeping the milliseconds."""
    return F.timestamp_millis(ms)


def event_time_whole_seconds(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp by whole seconds (fraction dropped)."""
    return F.timestamp_seconds(F.floor(ms / F.lit(1000)))


def from_epoch_seconds(seconds: Column) -> Column:
    """Epoch seconds, as a number or text with a fraction, to a timestamp."""
    return F.timestamp_micros(F.round(seconds.try_cast("double") * F.lit(1e6)).try_cast("bigint"))


DAY_MICROS = 86_400_000_000


def utc_day(ts: Column) -> Column:
    """Calendar day of an instant in UTC, whatever the session's zone."""
    micros = F.unix_micros(ts)
    days = F.call_function("div", micros - F.pmod(micros, F.lit(DAY_MICROS)), F.lit(DAY_MICROS))
    return F.date_add(F.date_from_unix_date(F.lit(0)), days.cast("int"))


_ZONELESS = r"^\s*\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d*)?)?)?\s*$"


def parse_timestamp_text(text: Column) -> Column:
    """Text to timestamp; unreadable text becomes NULL, text without a zone is UTC whatever the session's zone."""
    wall = text.try_cast("timestamp_ntz")
    utc = F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), wall))
    return F.when(text.rlike(_ZONELESS), utc).otherwise(F.try_to_timestamp(text))


def at(clock: Clock) -> Column:
    """The clock as a column: a given instant, a column, or the query's now."""
    if clock is None:
        return F.current_timestamp()
    if isinstance(clock, datetime):
        if clock.tzinfo is None:
            clock = clock.replace(tzinfo=timezone.utc)
        return F.timestamp_micros(F.lit(round(clock.timestamp() * 1_000_000)).cast("bigint"))
    return clock


def before(clock: Clock, interval: str) -> Column:
    """The instant ``interval`` before the clock, such as ``1 hour``."""
    return at(clock) - F.expr(f"INTERVAL {interval}")


def day_before(instant: datetime, interval: timedelta) -> date:
    """UTC day of the instant that lies ``interval`` before; without a zone it is UTC."""
    if instant.tzinfo is None:
        instant = instant.replace(tzinfo=timezone.utc)
    return (instant.astimezone(timezone.utc) - interval).date()


def naive(ts: Column) -> Column:
    """Timestamp without zone, for engines that keep UTC wall-clock times."""
    return ts.cast("timestamp_ntz")
