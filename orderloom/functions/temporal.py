"""Wall-clock time expressions. Everything is ``timestamp_ntz``: no session zone.

Zoned columns of sources are instants; they are compared as such, and written as text of their clock in UTC.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import as_col, lenient

WALL_CLOCK = "timestamp_ntz"
RUN_STAMP = "%Y%m%d%H%M"


@dataclass(frozen=True, order=True)
class Instant:
    """A moment in microseconds since 1970 in UTC: the same whatever zone a session or this process is in."""

    micros: int


def wall_clock(moment: datetime | Column) -> Column:
    """A time as the clock shows it. ``F.lit`` would take a naive time for an instant of this process's zone."""
    if isinstance(moment, Column):
        return moment.cast(WALL_CLOCK)
    return F.lit(moment.replace(tzinfo=None).isoformat(sep=" ")).cast(WALL_CLOCK)


def literal_of(value: object, data_type: T.DataType) -> Column:
    """A watermark as a literal of its column's type, so that the comparison is pushed into the scan.

    A wall-clock time on a zoned column, as older logs hold it, is one of the session's zone.
    """
    if isinstance(value, Instant):
        return F.timestamp_micros(F.lit(value.micros))
    if isinstance(value, datetime):
        return wall_clock(value).cast(data_type)
    return F.lit(value)


def utc_clock(moment: Column | str) -> Column:
    """What a clock in UTC shows at an instant; in no zone ambiguous."""
    seconds = (F.unix_micros(as_col(moment)).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast(WALL_CLOCK) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def at_utc_clock(clock: Column | str) -> Column:
    """The instant at which a clock in UTC shows a time, or its text."""
    return F.concat(as_col(clock).cast("string"), F.lit("Z")).cast("timestamp")


def strict_time(value: Column | str) -> Column:
    """Fails the job on text that is no timestamp."""
    return as_col(value).cast(WALL_CLOCK)


def lenient_time(value: Column | str) -> Column:
    """NULL for text that is no timestamp."""
    return lenient(value, WALL_CLOCK)


def unread(value: Column | str, read: Column | str | None = None) -> Column:
    """What ``lenient_time`` cannot read; ``read`` is what it gave, if that is at hand."""
    return F.when((lenient_time(value) if read is None else as_col(read)).isNull(), as_col(value))


def strictly(read: Column | str, unread: Column | str) -> Column:
    """The time that ``lenient_time`` read; fails the job on what it could not."""
    return F.coalesce(as_col(read), strict_time(unread))


def clock(duration: Column | str, width: int) -> Column:
    """``HH:MM`` (5) or ``HH:MM:SS`` (8) of a time printed as ``0 days HH:MM:SS``."""
    return F.substring(as_col(duration), 8, width)


def clock_text(day: Column | str, duration: Column | str) -> Column:
    """A day and a ``0 days HH:MM:SS`` time as the text of a timestamp; NULL if either is."""
    return F.concat(as_col(day).cast("string"), F.lit(" "), clock(duration, 8))


def at_clock(day: Column | str, duration: Column | str) -> Column:
    """Timestamp of a day and a ``0 days HH:MM:SS`` time; NULL if either is."""
    return strict_time(clock_text(day, duration))


def slot_label(slot: Column | str, start: Column | str, end: Column | str) -> Column:
    """``Slot <id> HH:MM-HH:MM``; NULL if any part is."""
    return F.concat(
        F.lit("Slot "), as_col(slot).cast("string"), F.lit(" "), clock(start, 5), F.lit("-"), clock(end, 5)
    )


def elapsed_minutes(start: Column | str, end: Column | str) -> Column:
    """Whole minutes from start to end, cut towards zero."""
    gap = as_col(end) - as_col(start)
    days, hours, minutes = (F.extract(F.lit(unit), gap).cast("bigint") for unit in ("DAY", "HOUR", "MINUTE"))
    return days * 1440 + hours * 60 + minutes


def pick_deadline(created: Column | str, slot_start: Column | str, minutes: int = 30) -> Column:
    """Slot start, or creation plus the lead time when the slot is closer than that."""
    if minutes <= 0:
        raise ValueError("the lead time must be positive")
    created, slot_start = as_col(created), as_col(slot_start)
    lead = F.lit(timedelta(minutes=minutes))
    return F.when(slot_start - created < lead, created + lead).otherwise(slot_start)


def earliest(first: Column | str, second: Column | str) -> Column:
    """Earlier of two timestamps; a NULL one does not count."""
    return F.least(as_col(first), as_col(second))


def iso_week(day: Column | str) -> Column:
    return F.lpad(F.weekofyear(as_col(day)).cast("string"), 2, "0")


def iso_year(day: Column | str) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), as_col(day)).cast("string")


def month_text(day: Column | str) -> Column:
    return F.lpad(F.month(as_col(day)).cast("string"), 2, "0")


def year_text(day: Column | str) -> Column:
    return F.year(as_col(day)).cast("string")


def week_label(day: Column | str) -> Column:
    """``wk-WW:YYYY``: ISO week beside the calendar year, so 2019-12-30 is ``wk-01:2019``."""
    return F.concat(F.lit("wk-"), iso_week(day), F.lit(":"), year_text(day))


def month_label(day: Column | str) -> Column:
    return F.concat(month_text(day), F.lit("-"), year_text(day))


def iso_labels(day: Column | str, prefix: str) -> dict[str, Column]:
    """Labels of a delivery day. ``yr_month`` joins the ISO year and the calendar month."""
    return {
        f"{prefix}_week": week_label(day),
        f"{prefix}_month_yr": month_label(day),
        f"{prefix}_yr": iso_year(day),
        f"{prefix}_yr_wk": F.concat(iso_year(day), iso_week(day)).try_cast("int"),
        f"{prefix}_yr_month": F.concat(iso_year(day), month_text(day)).try_cast("int"),
    }


def calendar_labels(day: Column | str, prefix: str) -> dict[str, Column]:
    """Labels of an order day, by calendar year (week by ISO)."""
    return {
        f"{prefix}_week": week_label(day),
        f"{prefix}_month_yr": month_label(day),
        f"{prefix}_month": month_text(day),
        f"{prefix}_yr": F.year(as_col(day)),
    }


def local_time_label(utc: Column | str | datetime, zone: str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in a zone, of a wall-clock UTC time."""
    moment = F.col(utc) if isinstance(utc, str) else utc
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), wall_clock(moment))
    return F.date_format(local, "yyyy-MM-dd HH:mm:ss")


def run_stamp(now: datetime) -> str:
    return now.strftime(RUN_STAMP)


def lookback_start(now: Column | datetime, days: int = 90) -> Column:
    """Lower bound of a rolling re-read."""
    return wall_clock(now) - F.lit(timedelta(days=days))
