"""Numeric expressions that never raise under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unit text that marks amounts filed in thousands, and its factor.
THOUSANDS_UNIT = "MIL"
THOUSANDS_FACTOR = 1000


def to_double(column: Column) -> Column:
    """Text to double; NULL where it is not a number."""
    return column.try_cast("double")


def to_bigint(column: Column) -> Column:
    """Text to 64-bit integer; NULL where it is not one. Share counts exceed 32 bits."""
    return column.try_cast("bigint")


def scale_units(value: Column, unit: Column, except_when: Column | None = None) -> Column:
    """Amounts in thousands to single units; a NULL unit leaves the amount as filed.

    ``except_when`` names rows that are already in single units, such as per-share figures.
    """
    scaled = F.contains(unit, F.lit(THOUSANDS_UNIT))
    if except_when is not None:
        scaled = scaled & ~F.coalesce(except_when, F.lit(False))
    return F.when(scaled, value * THOUSANDS_FACTOR).otherwise(value)


def is_invalid(column: Column) -> Column:
    """True for NULL and for NaN."""
    return column.isNull() | F.isnan(column)


def percentage(part: Column, whole: Column) -> Column:
    """Share of ``whole`` in percent, 0 for an empty whole."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))
