"""Time columns. All arithmetic is on naive timestamps, so no session time zone takes part."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.schema import TIME_FORMAT

HOUR, DAY = 3600, 86400


def parse_hour(text: Column | str) -> Column:
    return F.to_timestamp_ntz(text, F.lit(TIME_FORMAT))


def try_parse_hour(text: Column | str) -> Column:
    """:func:`parse_hour`, but NULL for a text that is no hour of a calendar day."""
    whole = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2} \d{2})$", 1)
    numbers = [F.when(whole != "", F.substring(whole, start, size)).cast("int") for start, size in ((1, 4), (6, 2), (9, 2), (12, 2))]
    return F.try_make_timestamp_ntz(*numbers, F.lit(0), F.lit(0))


def naive(moment: datetime) -> Column:
    return F.lit(f"{moment:%Y-%m-%d %H:%M:%S.%f}").cast("timestamp_ntz")


def hour_text(ts: Column | str) -> Column:
    """``HH``, zero padded."""
    return F.lpad(F.hour(ts).cast("string"), 2, "0")


def format_hour(ts: Column | str) -> Column:
    """The inverse of :func:`parse_hour`."""
    return F.concat_ws(" ", F.to_date(ts).cast("string"), hour_text(ts))


def truncate_hour(ts: Column | str) -> Column:
    midnight = F.to_date(ts).cast("timestamp_ntz")
    return midnight + F.make_dt_interval(F.lit(0), F.hour(ts))


def epoch_seconds(ts: Column | str) -> Column:
    whole = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(F.to_date(ts)).cast("bigint") * DAY + whole


def seconds_between(later: Column, earlier: Column) -> Column:
    return epoch_seconds(later) - epoch_seconds(earlier)


def whole_days(seconds: Column) -> Column:
    """24-hour periods, floored; not calendar days."""
    return F.floor(seconds / DAY).cast("bigint")


def hours(seconds: Column) -> Column:
    return seconds / F.lit(float(HOUR))


def days(seconds: Column) -> Column:
    return seconds / F.lit(float(DAY))


def in_band(hour: Column, band: tuple[int, int]) -> Column:
    """Whether an hour lies in a band; a band whose start is past its end wraps around midnight."""
    first, last = band
    if first <= last:
        return hour.between(first, last)
    return (hour >= first) | (hour <= last)
