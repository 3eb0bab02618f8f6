"""Epoch microseconds and zoneless timestamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_micros(us: Column) -> Column:
    """The zoneless UTC timestamp of epoch microseconds (in a UTC session)."""
    return F.timestamp_micros(us).cast("timestamp_ntz")


def to_micros(ts: Column) -> Column:
    """Epoch microseconds of a timestamp, with or without zone (in a UTC session)."""
    return F.unix_micros(ts.cast("timestamp"))


def bucket_start(us: Column, width: int) -> Column:
    """The start of the epoch-aligned interval of ``width`` microseconds; floors before 1970 too."""
    return us - F.pmod(us, F.lit(width))


def year_and_month(ts: Column) -> dict[str, Column]:
    """Lake keys of a timestamp; the month as two digits, which keeps one folder a month."""
    return {"year": F.year(ts), "month": F.date_format(ts, "MM")}


def micros_of(when: datetime) -> int:
    """Epoch microseconds of an aware datetime, without rounding."""
    if when.tzinfo is None:
        raise ValueError("a time needs a zone; give it in UTC")
    seconds = when.replace(microsecond=0).timestamp()
    return int(seconds) * 1_000_000 + when.microsecond
