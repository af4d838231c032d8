"""Dates, timestamps and numbers that arrive as text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date that stands for "never" in date padding and in update times.
NEVER = "1900-01-01"

# Fixed value: how long a failed code rests.
RETRY_AFTER = "INTERVAL 7 DAYS"

# A year alone, a year and month, or a bare clock time is not a date here, although
# Spark's cast would complete it.
_FULL_DATE = "^ *[0-9]{4,}-[0-9]{1,2}-[0-9]{1,2}"


def strict_timestamp(text: Column) -> Column:
    """UTC timestamp; text that is none stops the query."""
    return text.cast("timestamp")


def added_time(text: Column) -> Column:
    """When an item was added, strictly read; blank text is no date."""
    return strict_timestamp(F.nullif(F.trim(text), F.lit("")))


def safe_timestamp(text: str) -> str:
    """SQL for a UTC timestamp, NULL for text that is none."""
    return f"if({text} rlike '{_FULL_DATE}', try_cast({text} as timestamp), null)"


def safe_date(text: str) -> str:
    """SQL for a date, NULL for partial or malformed text."""
    return f"cast({safe_timestamp(text)} as date)"


def safe_int(text: str) -> str:
    """SQL for an INT, rounding decimals and reading exponents, NULL for other text."""
    return f"try_cast(round(try_cast({text} as decimal(38,6)), 0) as int)"


def moment(as_of: dt.datetime) -> Column:
    """The point in time a run counts as 'now', as a literal."""
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def days_until(as_of: dt.datetime, date: Column) -> Column:
    """Whole days from ``date`` to the run's day."""
    return F.datediff(F.lit(as_of.date()), date.cast("date")).cast("bigint")


def or_never(timestamp: Column) -> Column:
    return F.coalesce(timestamp, F.lit(NEVER).cast("timestamp"))


def pad_release_date(date: Column, precision: Column) -> Column:
    """Complete a year or a year-month to a full date text."""
    return (
        F.when(F.coalesce(date, F.lit("")) == "", NEVER)
        .when(precision == "year", F.concat(date, F.lit("-01-01")))
        .when(precision == "month", F.concat(date, F.lit("-01")))
        .otherwise(date)
    )
