"""Time expressions.

Instants are TIMESTAMP; stored times are TIMESTAMP_NTZ wall-clock at millisecond
precision in a named zone. The conversions count from the epoch instead of casting,
so the session zone (and its DST gaps) never enters.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def epoch_ms_to_ts(ms: Column | str) -> Column:
    """Epoch milliseconds to an instant; NULL stays NULL."""
    return F.timestamp_millis(ms)


def first_event_time(*ms_columns: str) -> Column:
    """Instant of the first non-NULL epoch-millisecond column, in the order given."""
    return epoch_ms_to_ts(F.coalesce(*[F.col(c) for c in ms_columns]))


def to_wall_clock(ts: Column, zone: str) -> Column:
    """Instant to wall-clock time in ``zone``, cut to milliseconds."""
    utc = F.timestamp_add("MILLISECOND", F.unix_millis(ts), F.expr(EPOCH))
    if zone == "UTC":
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def wall_clock(df: DataFrame, column: str, zone: str) -> Column:
    """``column`` of ``df`` as wall-clock time; a column that already is one passes through."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.col(column)
    return to_wall_clock(F.col(column), zone)


def millis_between(earlier: Column, later: Column) -> Column:
    """Milliseconds from one wall-clock time to another."""
    # The whole seconds of a thousandfold interval: exact, and no decimal arithmetic per row.
    return ((later - earlier) * 1000).cast("interval second").cast("bigint")


def wall_clock_to_epoch_ms(ntz: Column, zone: str) -> Column:
    """Wall-clock time in ``zone``, of millisecond precision, to epoch milliseconds."""
    utc = ntz if zone == "UTC" else F.convert_timezone(F.lit(zone), F.lit("UTC"), ntz)
    return millis_between(F.expr(EPOCH), utc)


def processing_time(zone: str) -> Column:
    """Now as wall-clock time. Constant within one query or micro-batch."""
    return to_wall_clock(F.current_timestamp(), zone)


def zoned_instant(text: str) -> Column:
    """Instant of a literal such as ``2026-03-13 12:00:00 Asia/Seoul``."""
    return F.lit(text).cast("timestamp")


def hour_floor(ntz: Column) -> Column:
    """The full hour of a wall-clock time, without a detour over the session zone."""
    hours = F.floor(millis_between(F.expr(EPOCH), ntz) / 3_600_000).cast("int")
    return F.timestamp_add("HOUR", hours, F.expr(EPOCH))


def clock_goes_back(zone: str, first: date, last: date) -> bool:
    """Whether some wall-clock time of these days comes twice in ``zone``."""
    here, day = ZoneInfo(zone), timedelta(days=1)
    at = datetime.combine(max(first, date.min + 2 * day), time(), timezone.utc) - day
    end = datetime.combine(min(last, date.max - 3 * day), time(), timezone.utc) + 2 * day
    offset = at.astimezone(here).utcoffset()
    while at < end:
        at += day
        before, offset = offset, at.astimezone(here).utcoffset()
        if offset < before:
            return True
    return False


def minute_floor(ts: Column) -> Column:
    return F.date_trunc("minute", ts)
