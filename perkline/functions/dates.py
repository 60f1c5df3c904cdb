"""Date and duration expressions. The reference day is always an argument."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | date | Column) -> Column:
    """ISO text, a Python date or a column as a DATE column."""
    return value.cast("date") if isinstance(value, Column) else F.lit(str(value)).cast("date")


def as_timestamp(value: str | Column) -> Column:
    return value.cast("timestamp") if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def excel_serial_to_date(text: Column, strict: bool = True) -> Column:
    """Spreadsheet day number or timestamp text as a DATE.

    Empty text is NULL. Fractions round half up to a whole day. Other unreadable text raises,
    or becomes NULL when ``strict`` is off.
    """
    trimmed = F.trim(text)
    is_serial = trimmed.rlike(r"^[0-9]+(\.[0-9]+)?$")
    # guard the cast itself: some plans evaluate both branches of a conditional
    number = F.when(is_serial, trimmed).cast("decimal(38,18)")
    days = F.round(number, 0).cast("int")
    stamp = F.when(~is_serial & (text != ""), text)
    parsed = stamp.cast("timestamp") if strict else stamp.try_cast("timestamp")
    return (
        F.when(F.nullif(text, F.lit("")).isNull(), F.lit(None).cast("date"))
        .when(is_serial, F.date_add(as_date("1899-12-30"), days))
        .otherwise(parsed.cast("date"))
    )


def duration_seconds(start: Column, end: Column, as_of_ts: str | Column) -> Column:
    """Seconds from ``start`` to ``end``; a missing end counts up to ``as_of_ts``."""
    stop = F.coalesce(end, as_timestamp(as_of_ts))
    return F.timestamp_diff("MICROSECOND", start, stop) / F.lit(1_000_000.0)


def reference_year(as_of: str | date | Column) -> Column:
    return F.year(as_date(as_of))


def epoch_day(day: Column) -> Column:
    """Days since 1970-01-01 as an integer."""
    return F.unix_date(day)
