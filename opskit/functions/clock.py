"""Time functions: boundary differences, encoded dates and durations, rounding rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_SECONDS = {"second": 1, "minute": 60, "hour": 3600}


def epoch_us(c) -> Column:
    return F.unix_micros(_c(c).cast("timestamp"))


def datediff_boundary(unit: str, a, b) -> Column:
    """Number of unit boundaries crossed from ``a`` to ``b`` (not whole elapsed units)."""
    a, b = _c(a), _c(b)
    if unit in _SECONDS:
        step = _SECONDS[unit] * 1_000_000
        return F.floor(epoch_us(b) / step).cast("bigint") - F.floor(epoch_us(a) / step).cast("bigint")
    if unit == "day":
        return F.datediff(b, a).cast("bigint")
    months = (F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))
    if unit == "month":
        return months.cast("bigint")
    if unit == "year":
        return (F.year(b) - F.year(a)).cast("bigint")
    raise ValueError(unit)


def to_smalldatetime(c) -> Column:
    """Nearest minute (30 seconds round up)."""
    return F.date_trunc("minute", _c(c) + F.expr("interval 30 seconds"))


def time_bucket(ts, minutes: int) -> Column:
    """Start of the n-minute bucket, aligned to midnight for divisors of a day."""
    step = minutes * 60 * 1_000_000
    return F.timestamp_micros((F.floor(epoch_us(ts) / step) * step).cast("bigint"))


def int_datetime(d, t) -> Column:
    """yyyymmdd and hhmmss integers to a timestamp."""
    text = F.concat(F.lpad(_c(d).cast("string"), 8, "0"), F.lpad(_c(t).cast("string"), 6, "0"))
    return F.to_timestamp(text, "yyyyMMddHHmmss")


def hhmmss_to_seconds(c) -> Column:
    """Integer HHMMSS (hours may exceed 99) to seconds."""
    c = _c(c)
    return (F.floor(c / 10000) * 3600 + F.floor(c / 100) % 100 * 60 + c % 100).cast("bigint")


def hhmmss_to_minutes(c, rule: str = "half_up") -> Column:
    """Two rounding rules: ``half_up`` adds a minute above 29 s, ``plus31`` adds 31 s first."""
    seconds = hhmmss_to_seconds(c)
    if rule == "half_up":
        return (F.floor(seconds / 60) + F.when(_c(c) % 100 > 29, 1).otherwise(0)).cast("bigint")
    if rule == "plus31":
        return F.floor((seconds + 31) / 60).cast("bigint")
    raise ValueError(rule)


def fmt_duration(seconds) -> Column:
    """Seconds to ``dd hh:mm:ss``."""
    s = _c(seconds).cast("bigint")
    return F.format_string(
        "%02d %02d:%02d:%02d",
        F.floor(s / 86400).cast("bigint"),
        (F.floor(s / 3600) % 24).cast("bigint"),
        (F.floor(s / 60) % 60).cast("bigint"),
        s % 60,
    )


def parse_duration(c) -> Column:
    """``dd hh:mm:ss`` (a fraction may follow) to seconds."""
    part = lambda i: F.regexp_extract(_c(c), r"^(\d+) (\d+):(\d+):(\d+)", i).cast("bigint")
    return part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4)


def fmt_date(c, pattern: str) -> Column:
    return F.date_format(_c(c), pattern)


def to_utc(c, zone: str) -> Column:
    return F.to_utc_timestamp(_c(c), zone)


def to_local(c, zone: str) -> Column:
    return F.from_utc_timestamp(_c(c), zone)
