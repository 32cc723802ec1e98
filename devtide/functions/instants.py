"""Instants, date keys and durations. All of them assume a UTC session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted shape of an ISO-8601 instant.
ISO_INSTANT = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?"
    r"(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)

MICROS_PER_HOUR = 3_600_000_000


def parse_instant(text: Column) -> Column:
    """ISO-8601 text to an instant; NULL where it is not one. No offset means UTC."""
    hour_only = r"^(.{10}[T ]\d{2})(?=$|Z|[+-])"
    minute_only = r"^(.{10}[T ]\d{2}:\d{2})(?=$|Z|[+-])"
    padded = F.regexp_replace(F.regexp_replace(text, hour_only, "$1:00"), minute_only, "$1:00")
    # With seconds in place there is nothing to pad, which is the usual case.
    complete = F.when(F.substring(text, 17, 1) == ":", text).otherwise(padded)
    canonical = F.replace(complete, F.lit(","), F.lit("."))
    return F.when(text.rlike(ISO_INSTANT), canonical.try_cast("timestamp"))


def date_key(ts: Column) -> Column:
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def week_start(ts: Column) -> Column:
    """The Monday of the week of ``ts``."""
    return F.trunc(F.to_date(ts), "week")


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month")


def micros_between(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def hours_between(start: Column, end: Column) -> Column:
    """Hours with two decimals, rounded half away from zero; NULL if either is missing."""
    exact = micros_between(start, end).cast("decimal(20,0)") / F.lit(MICROS_PER_HOUR).cast(
        "decimal(10,0)"
    )
    return F.round(exact, 2).cast("decimal(12,2)")
