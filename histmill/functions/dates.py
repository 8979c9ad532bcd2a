"""Date functions (SC18-SC20)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_UTC_OFFSET_HOURS = 5  # fixed shift of the source server's local time, no DST


def shift_hours(ts: Column, hours: int = DEFAULT_UTC_OFFSET_HOURS) -> Column:
    return ts + F.make_interval(hours=F.lit(hours))


def iso_text(ts: Column) -> Column:
    """ISO-8601 text; milliseconds are printed only when they are not zero."""
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    millis = F.date_format(ts, "SSS")
    return F.when(millis == "000", base).otherwise(F.concat(base, F.lit("."), millis))


def utc_iso(ts: Column, hours: int = DEFAULT_UTC_OFFSET_HOURS) -> Column:
    """SC18: shift to UTC and format."""
    return iso_text(shift_hours(ts, hours))


def parse_iso(text: Column) -> Column:
    """SC20: ISO text -> timestamp without zone."""
    return F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd'T'HH:mm:ss"))
