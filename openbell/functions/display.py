"""Formatting of report numbers; a missing value prints as a dash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "—"


def _or_dash(value, text: Column) -> Column:
    return F.when(value.isNotNull(), text).otherwise(F.lit(MISSING))


def whole(value: Column) -> Column:
    """Integer text, ties to even; bround first because the Java formatter
    rounds ties up."""
    return F.bround(value, 0).cast("bigint").cast("string")


def _formatted(value: Column, pattern: str, digits: int) -> Column:
    # format_string prints "null" for NULL, so keep NULL out of it
    return F.when(value.isNotNull(), F.format_string(pattern, F.bround(value, digits)))


def fixed(value: Column, digits: int) -> Column:
    return _formatted(value, f"%.{digits}f", digits)


def signed(value: Column, digits: int) -> Column:
    return _formatted(value, f"%+.{digits}f", digits)


def bps(value: Column) -> Column:
    return _or_dash(value, F.concat(whole(value * 10000), F.lit(" bps")))


def percent(value: Column, digits: int = 2) -> Column:
    return _or_dash(value, F.concat(fixed(value * 100, digits), F.lit("%")))
