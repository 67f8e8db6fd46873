"""Date and time column helpers.  All timestamps are zone-free (``timestamp_ntz``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(text: Column, pattern: str | None = None) -> Column:
    """Text to a zone-free timestamp; NULL when it is not one."""
    if pattern is None:
        return text.try_cast("timestamp_ntz")
    return F.to_timestamp_ntz(text, F.lit(pattern))


def month_label(ts: Column) -> Column:
    """``YYYY-MM``."""
    return F.date_format(ts, "yyyy-MM")


def weekday_name(ts: Column) -> Column:
    """Full English weekday name."""
    return F.date_format(ts, "EEEE")


def month_number(ts: Column) -> Column:
    """Months since year 0, so that differences count month boundaries."""
    return F.year(ts) * 12 + F.month(ts)


def label_of_number(number: Column) -> Column:
    """``YYYY-MM`` of a ``month_number``."""
    year, month = F.floor((number - 1) / 12).cast("int"), (number - 1) % 12 + 1
    return F.format_string("%04d-%02d", year, month)


def months_between_labels(earlier: Column, later: Column) -> Column:
    """Month boundaries crossed from ``earlier`` to ``later`` (both date or timestamp)."""
    return month_number(later) - month_number(earlier)


def month_start(ts: Column) -> Column:
    return F.date_trunc("month", ts)


def whole_days(earlier: Column, later: Column) -> Column:
    """Completed 24-hour spans between two timestamps (not calendar days)."""
    return F.extract(F.lit("DAY"), later - earlier).cast("int")


def calendar_days(earlier: Column, later: Column) -> Column:
    """Calendar days between two dates."""
    return F.date_diff(later, earlier)


def report_day(ts: Column) -> Column:
    """The day after: reports are written one day late."""
    return ts + F.expr("INTERVAL 1 DAY")


def days_in_month(ts: Column, leap: bool = True) -> Column:
    """Days of the month of ``ts``; February has always 28 when ``leap`` is off."""
    days = F.day(F.last_day(ts))
    if leap:
        return days
    return F.when(F.month(ts) == 2, F.lit(28)).otherwise(days)


def weeks_in_month(ts: Column, leap: bool = True) -> Column:
    return days_in_month(ts, leap) / F.lit(7.0)


def date_or_28(year: Column, month: Column, day: Column) -> Column:
    """Build a date; a day the month does not have becomes the 28th."""
    last = F.day(F.last_day(F.make_date(year, month, F.lit(1))))
    return F.make_date(year, month, F.when(day > last, F.lit(28)).otherwise(day))
