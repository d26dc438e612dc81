"""Time expressions. Instants are `timestamp`; a calendar day always names its zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import DAY_TEXT, SHOP_ZONE, TIME_TEXT


def event_time(millis: Column | str) -> Column:
    return F.timestamp_millis(F.col(millis) if isinstance(millis, str) else millis)


def local_time(ts: Column, zone: str | None = None) -> Column:
    """Wall-clock time of an instant in `zone` (default: the session's zone), independent of the session's zone."""
    wall = ts.cast("timestamp_ntz")
    return wall if zone is None else F.convert_timezone(F.current_timezone(), F.lit(zone), wall)


def day_of(ts: Column, zone: str | None = None) -> Column:
    return F.to_date(local_time(ts, zone))


def time_text(ts: Column, zone: str | None = None) -> Column:
    """`yyyy-MM-dd HH:mm:ss`; a cast prints just that before the fraction, and far faster than a pattern."""
    return F.substring(local_time(ts, zone).cast("string"), 1, len(TIME_TEXT))


def text_time(text: Column | str) -> Column:
    """`yyyy-MM-dd HH:mm:ss` read in the session's zone; a malformed text fails the job."""
    return (F.col(text) if isinstance(text, str) else text).cast("timestamp")


def text_millis(text: Column, offset: str = SHOP_ZONE) -> Column:
    """Epoch milliseconds of a `yyyy-MM-dd HH:mm:ss` text written at a fixed offset."""
    return F.unix_millis(F.concat(text, F.lit(offset)).cast("timestamp"))


def day_number(ts: Column, zone: str | None = None) -> Column:
    """The day as `yyyyMMdd` digits."""
    return F.date_format(local_time(ts, zone), DAY_TEXT).cast("int")


def years_between(day: Column, as_of: Column) -> Column:
    """Whole 365-day years from `day` to `as_of`, truncated."""
    return (F.datediff(as_of, day) / 365).cast("int")


def window_bounds(window: Column, zone: str | None = None) -> list[Column]:
    """Start and end of a window as the texts `stt` and `edt`."""
    return [
        time_text(window["start"], zone).alias("stt"),
        time_text(window["end"], zone).alias("edt"),
    ]


def stamp_millis() -> Column:
    """Time of writing; for sinks only, never for results that must repeat."""
    return F.unix_millis(F.current_timestamp())
