"""Scalar functions as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def number_or(c: Column, default: float) -> Column:
    return F.coalesce(c, F.lit(default))


def long_or_zero(c: Column) -> Column:
    return F.coalesce(c.cast("long"), F.lit(0).cast("long"))


def long_or(c: Column, default: int) -> Column:
    return F.coalesce(c.cast("long"), F.lit(default).cast("long"))


def integer_or_zero(c: Column) -> Column:
    return F.coalesce(c.cast("int"), F.lit(0))


def integer_or(c: Column, default: int) -> Column:
    return F.coalesce(c.cast("int"), F.lit(default))


def string_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def string_or(c: Column, default: str) -> Column:
    return F.coalesce(c, F.lit(default))


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def split_literal(c: Column, separator: str) -> Column:
    """Split at a literal separator; empty parts stay."""
    return F.split(c, re.escape(separator), -1)


def joined(c: Column) -> Column:
    return F.array_join(c, ",")


def session_id(key: Column, first_millis: Column) -> Column:
    """The key and the first event's time as 16 lower-case hexadecimal digits."""
    return F.concat(key, F.lpad(F.lower(F.hex(first_millis)), 16, "0"))


def floor_millis(millis: Column, step_millis: int) -> Column:
    return millis - F.pmod(millis, F.lit(step_millis))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ column, whatever the session's time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def day_at_offset(millis: Column, hours: int) -> Column:
    """yyyy-MM-dd of a time at a fixed offset from UTC, whatever the session's time zone."""
    days = F.floor((millis + F.lit(hours * 3_600_000)) / F.lit(86_400_000)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")


def formatted_at_zone(millis: Column, zone: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """A time as text in a zone, whatever the session's time zone."""
    wall = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.timestamp_add("MILLISECOND", millis, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))
    return F.date_format(wall, pattern)


def parsed_at_zone(text: Column, zone: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch milliseconds of a time written in a zone; null where it can't be read."""
    wall = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), wall)
    return F.floor(epoch_micros(utc) / 1000).cast("long")
