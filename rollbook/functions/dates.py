"""Date and week arithmetic matching the warehouse semantics.

Weeks start on Monday (``DATE_TRUNC(d, WEEK(MONDAY))``); week differences
are taken between Monday-truncated dates, so they are exact multiples of 7.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def week_start(col) -> Column:
    """Monday of the week holding ``col`` (date or timestamp) as a DATE."""
    return F.to_date(F.date_trunc("week", F.to_date(_c(col))))


def weeks_between(end, start) -> Column:
    """``DATE_DIFF(end, start, WEEK(MONDAY))`` for Monday-truncated dates."""
    return F.floor(F.datediff(week_start(end), week_start(start)) / F.lit(7)).cast("long")


def format_week_range(week_start_col, week_end_col) -> Column:
    """``'%b %d' || ' - ' || '%b %d'``, e.g. ``Jan 08 - Jan 14`` (null-propagating)."""
    return F.concat(F.date_format(_c(week_start_col), "MMM dd"), F.lit(" - "),
                    F.date_format(_c(week_end_col), "MMM dd"))


def day_name(col) -> Column:
    """``FORMAT_TIMESTAMP('%A', d)``: full English weekday name."""
    return F.date_format(_c(col), "EEEE")


def format_month(col) -> Column:
    """``FORMAT_DATE('%B %Y', d)``, e.g. ``November 2025``."""
    return F.date_format(_c(col), "MMMM yyyy")


def parse_month(col) -> Column:
    """``PARSE_DATE('%B %Y', s)`` → first day of that month (null when unparsable)."""
    return F.try_to_date(_c(col), "MMMM yyyy")


def month_start(col) -> Column:
    return F.trunc(_c(col), "month")


def local_date(ts, tz: str) -> Column:
    """``DATE(ts, tz)``: calendar date of a UTC instant in zone ``tz``."""
    return F.to_date(F.from_utc_timestamp(_c(ts).cast("timestamp"), tz))


def is_friday(col) -> Column:
    """``EXTRACT(DAYOFWEEK FROM d) = 6`` (Sunday = 1)."""
    return F.dayofweek(_c(col)) == F.lit(6)


def is_month_end(col) -> Column:
    return _c(col) == F.last_day(_c(col))
