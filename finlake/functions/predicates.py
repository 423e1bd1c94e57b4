"""Row predicates over filed text. All ignore case and keep accents distinct."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches(column: Column, pattern: str) -> Column:
    """Lower-cased text matches a regular expression somewhere."""
    return F.lower(column).rlike(pattern)


def same_text(column: Column, value: str) -> Column:
    """Case-insensitive equality."""
    return F.lower(column) == F.lower(F.lit(value))


def has_text(column: Column, fragment: str) -> Column:
    """Case-insensitive containment."""
    return F.contains(F.lower(column), F.lower(F.lit(fragment)))


def after(column: Column, as_of) -> Column:
    """Later than the reporting date; NULL dates do not count."""
    return column > F.lit(as_of)
