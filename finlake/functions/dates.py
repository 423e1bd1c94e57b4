"""Date expressions and the calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The filings' date format and the months that end a quarter.
DATE_FORMAT = "yyyy-MM-dd"
DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
QUARTER_END_MONTHS = (3, 6, 9, 12)


def parse_date(column: Column, pattern: str = DATE_FORMAT) -> Column:
    """Text to date; NULL where it is not a calendar date written in the pattern.

    The filings' own format is read by a cast, several times faster than a formatter; as a cast alone would
    also take other spellings, the shape is checked first.
    """
    if pattern != DATE_FORMAT:
        return F.try_to_date(column, pattern)
    return F.when(column.rlike(DATE_SHAPE), column.try_cast("date"))


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Attributes of the calendar dimension, by column name."""
    last = day == F.last_day(day)
    return {
        "ano": F.year(day),
        "mes": F.month(day),
        "trimestre": F.quarter(day),
        "semestre": F.when(F.quarter(day) <= 2, 1).otherwise(2),
        "dia": F.dayofmonth(day),
        "ano_trimestre": F.concat(F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string")),
        "ano_mes": F.date_format(day, "yyyy-MM"),
        "eh_fim_trimestre": F.month(day).isin(*QUARTER_END_MONTHS) & last,
        "eh_fim_ano": (F.month(day) == 12) & last,
    }
