"""Dates, timestamps and windows of time.  All on zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.fixed_values import BLANK_DATE


def cast_datetime(text: Column) -> Column:
    """Text to timestamp; unreadable text becomes NULL."""
    return text.try_cast("timestamp_ntz")


def zero_to_null_date(text: Column) -> Column:
    """``0`` stands for "no date"."""
    return F.when(F.trim(text) == "0", F.lit(None)).otherwise(cast_datetime(text))


def blank_date_to_sentinel(text: Column) -> Column:
    """Blank or missing date text becomes the far-future sentinel."""
    filled = F.when(text.rlike(r"^\s*$"), F.lit(None)).otherwise(text)
    return F.coalesce(filled, F.lit(BLANK_DATE))


def sentinel_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(BLANK_DATE))


def date_sentinel_roundtrip(text: Column) -> Column:
    """What a date column holds after the sentinel has been written and cleared."""
    return sentinel_to_null(blank_date_to_sentinel(text))


def format_seconds(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; the fraction is cut, not rounded."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 with microseconds, as ``decimal(20,6)``.

    Works on the interval, so the session time zone has no say.
    """
    span = ts.cast("timestamp_ntz") - F.lit("1970-01-01").cast("timestamp_ntz")

    def part(unit: str) -> Column:
        return F.extract(F.lit(unit), span).cast("decimal(20,6)")

    total = part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")
    return total.cast("decimal(20,6)")


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(days=F.lit(days))


def day_end(ts: Column) -> Column:
    """23:59:59.999999 of the same day."""
    start = F.date_trunc("DAY", ts).cast("timestamp_ntz")
    return start + F.expr("INTERVAL '1' DAY") - F.expr("INTERVAL '0.000001' SECOND")


def previous_day_end(ts: Column) -> Column:
    return day_end(days_before(ts, 1))
