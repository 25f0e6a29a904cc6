"""Unit conversion and guarded arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNITS = ("B", "KB", "MB", "GB", "TB")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a, b) -> Column:
    """Integer division that truncates toward zero; NULL for a zero divisor."""
    a, b = _c(a).cast("bigint"), _c(b).cast("bigint")
    return F.when(b != 0, F.try_divide(a - a % F.nullif(b, F.lit(0)), b).cast("bigint"))


def ratio_or_null(a, b) -> Column:
    return F.try_divide(_c(a), _c(b))


def ratio_or_zero(a, b) -> Column:
    """0 when there is nothing to divide by."""
    return F.when(_c(b) == 0, F.lit(0.0)).otherwise(F.try_divide(_c(a), _c(b)))


def scale_units(c, src: str, dst: str) -> Column:
    """Integer roll-up between binary units (KB to GB and so on)."""
    steps = UNITS.index(dst) - UNITS.index(src)
    factor = 1024 ** abs(steps)
    c = _c(c).cast("bigint")
    return F.floor(c / factor).cast("bigint") if steps >= 0 else c * factor


def parse_size(c) -> Column:
    """``123 KB`` to bytes."""
    number = F.regexp_extract(_c(c), r"^\s*([0-9.]+)", 1).try_cast("double")
    unit = F.upper(F.regexp_extract(_c(c), r"([A-Za-z]+)\s*$", 1))
    power = F.when(unit == "KB", 1).when(unit == "MB", 2).when(unit == "GB", 3).when(unit == "TB", 4).otherwise(0)
    return (number * F.pow(F.lit(1024.0), power)).cast("bigint")


def fmt_size(c) -> Column:
    """Bytes to whole ``gb``, ``mb`` or ``kb`` text, the largest unit that is at least one."""
    c = _c(c).cast("bigint")
    text = lambda p, u: F.concat(F.floor(c / 1024**p).cast("string"), F.lit(f" {u}"))
    return (
        F.when(c == 0, "0")
        .when(c >= 1024**3, text(3, "gb"))
        .when(c >= 1024**2, text(2, "mb"))
        .otherwise(text(1, "kb"))
    )
