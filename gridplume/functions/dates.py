"""Month arithmetic, date parsing and chunk names, as native expressions.

Every function takes the day it is asked about; none reads the clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOOKBACK_DAYS = 90
_MONTH = "interval 1 month"


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_bounds(year: Column, month: Column) -> Column:
    """First and last day of a month as a struct ``(first_day, last_day)``."""
    first = F.make_date(year, month, F.lit(1))
    return F.struct(first.alias("first_day"), F.last_day(first).alias("last_day"))


def last_completed_month(as_of: Column) -> Column:
    """First day of the newest month that ended before ``as_of``."""
    return F.add_months(month_start(as_of), -1)


def clamp_to_completed(day: Column, as_of: Column) -> Column:
    """``day``, or the last completed month where ``day`` lies in the running month or later."""
    return F.when(day >= month_start(as_of), last_completed_month(as_of)).otherwise(day)


def month_range(first: Column, last: Column) -> Column:
    """Array of month starts from ``first`` to ``last``; empty when ``last`` is before ``first``."""
    none = F.array().cast("array<date>")
    return F.when(first <= last, F.sequence(first, last, F.expr(_MONTH))).otherwise(none)


def lookback_months(as_of: Column, days: int = LOOKBACK_DAYS) -> Column:
    """Completed months that the ``days`` before ``as_of`` touch, oldest first."""
    return month_range(month_start(F.date_sub(as_of, days)), last_completed_month(as_of))


def default_load_date(as_of: Column) -> Column:
    return F.date_sub(as_of, 1)


def month_number(day: Column) -> Column:
    """202401 for any day in January 2024: one number that orders months."""
    return F.year(day) * 100 + F.month(day)


def chunk_key(state: Column, year: Column, month: Column) -> Column:
    return F.format_string("%s-%d-%02d", state, year, month)


def chunk_path(state: Column, year: Column, month: Column) -> Column:
    """Folder of a chunk below the lake root, as the partitioned write lays it out."""
    return F.format_string("state=%s/year=%d/month=%02d", state, year, month)


def try_date(text: Column) -> Column:
    """ISO date or date-time text as a date, NULL where it is neither; the time of day is dropped."""
    trimmed = F.trim(text)
    return F.when(F.length(trimmed) <= 10, trimmed.try_cast("date")).otherwise(
        trimmed.try_cast("timestamp_ntz").cast("date")
    )


def is_bad_date(day: Column, text: Column) -> Column:
    """True where ``text`` is there and ``day``, which ``try_date`` found in it, is not.
    Blank text and not-a-time marks count as missing."""
    missing = F.lower(F.trim(text)).isin("", "nat", "nan")
    return day.isNull() & F.coalesce(~missing, F.lit(False))


def strict_date(day: Column, text: Column) -> Column:
    """``day``, but bad text fails the job, in any session, ANSI or not."""
    failure = F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date")
    return F.when(is_bad_date(day, text), failure).otherwise(day)
