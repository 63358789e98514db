"""Date helpers: recency cut-off (X1), YYYYMMDD reformat (X7), local-day
export window (F4 / X8) and typed timestamp literals."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UTC = dt.timezone.utc

# Fixed value: the reference's export time zone.
LOCAL_ZONE = "Asia/Bangkok"


def months_back(as_of: Column | str | dt.date | None, months: int) -> Column:
    """``add_months(as_of, -months)``; ``as_of`` defaults to
    ``current_date()``. A day past the target month's end clamps to it
    (2024-08-31 minus 6 months = 2024-02-29)."""
    if as_of is None:
        base = F.current_date()
    elif isinstance(as_of, Column):
        base = as_of
    else:
        base = F.lit(str(as_of)).cast("date")
    return F.add_months(base, -int(months))


def session_today(spark: SparkSession) -> dt.date:
    """Today by the session's clock and time zone."""
    return spark.range(1).select(F.current_date()).first()[0]


def yyyymmdd_to_iso(column: Column) -> Column:
    """``'20240105'`` → ``'2024-01-05'``; unparsable text gives NULL."""
    return F.date_format(F.try_to_date(column, "yyyyMMdd"), "yyyy-MM-dd")


def _parse_trigger(trigger: str | dt.datetime) -> dt.datetime:
    if isinstance(trigger, str):
        text = trigger.strip().replace("Z", "+00:00")
        # The reference drops the fractional part before parsing.
        head, _, tail = text.partition(".")
        if tail:
            offset = ""
            for sign in ("+", "-"):
                if sign in tail:
                    offset = sign + tail.split(sign, 1)[1]
                    break
            text = head + offset
        trigger = dt.datetime.fromisoformat(text)
    trigger = trigger.replace(microsecond=0)
    if trigger.tzinfo is None:
        trigger = trigger.replace(tzinfo=UTC)
    return trigger.astimezone(UTC)


def local_day_window(trigger: str | dt.datetime, tz: str = LOCAL_ZONE) -> tuple[dt.datetime, dt.datetime, str]:
    """F4 / X8 for one job trigger time (a parameter, not data).

    The trigger is a UTC time; its fractional seconds are cut off. In zone
    ``tz`` the window is ``[yesterday 00:00, today 00:00)``. Returned as naive
    UTC datetimes (the lake stores UTC wall-clock) plus ``data_dt`` =
    yesterday as ``YYYYMMDD``.
    """
    local = _parse_trigger(trigger).astimezone(ZoneInfo(tz))
    today = local.replace(hour=0, minute=0, second=0, microsecond=0)
    # Build midnights from calendar dates so DST days are handled by the zone.
    start_local = dt.datetime.combine(today.date() - dt.timedelta(days=1), dt.time(), ZoneInfo(tz))
    end_local = dt.datetime.combine(today.date(), dt.time(), ZoneInfo(tz))
    to_naive = lambda t: t.astimezone(UTC).replace(tzinfo=None)
    return to_naive(start_local), to_naive(end_local), start_local.strftime("%Y%m%d")


def local_day_bounds(trigger_utc: Column, tz: str = LOCAL_ZONE) -> tuple[Column, Column]:
    """Column form of the same window for a column of trigger times held as
    UTC wall-clock ``timestamp_ntz`` (the lake's convention): to local time
    with ``convert_timezone``, cut to the second and to the day, back to
    UTC. Returns ``[start, end)`` as UTC wall-clock ``timestamp_ntz``; every
    step works on wall-clock values, so the session time zone plays no part."""
    utc = F.lit("UTC")
    zone = F.lit(tz)
    local = F.convert_timezone(utc, zone, F.date_trunc("second", trigger_utc).cast("timestamp_ntz"))
    midnight = F.date_trunc("DAY", local).cast("timestamp_ntz")
    yesterday = (midnight - F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz")
    return F.convert_timezone(zone, utc, yesterday), F.convert_timezone(zone, utc, midnight)


def ts_literal(value: dt.datetime, dtype: T.DataType) -> Column:
    """A literal of the column's own timestamp type, so comparisons need no
    cast on the column side and reach the Parquet scan as pushed filters."""
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(dtype, T.DateType):
        return F.lit(value.date().isoformat()).cast("date")
    # Zoned timestamp: the naive value is a UTC instant. An aware literal
    # carries the instant itself, whatever the session time zone.
    return F.lit(value.replace(tzinfo=UTC))


def utc_wall_to_instant(column: Column, session_tz: str) -> Column:
    """A ``timestamp_ntz`` holding UTC wall-clock time → the zoned timestamp
    of that instant, whatever the session time zone ``session_tz``."""
    return F.from_utc_timestamp(column.cast("timestamp"), session_tz)


def instant_to_utc_wall(column: Column, session_tz: str) -> Column:
    """Inverse of ``utc_wall_to_instant``: a zoned timestamp → its UTC
    wall-clock time as ``timestamp_ntz``."""
    return F.to_utc_timestamp(column, session_tz).cast("timestamp_ntz")
