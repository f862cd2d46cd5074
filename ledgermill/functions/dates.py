"""Dates: strict and tolerant parsing, and the month label of the charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

# Date formats found in the extracts, and the labels of the charts.
ISO = "yyyy-MM-dd"
DAY_FIRST = "dd/MM/yyyy"
MONTH = "yyyy-MM"
NO_MONTH = "NaT"

#: ISO with one- or two-digit month and day, which the dataframe readers of the raw mode accept.
LENIENT_ISO = "yyyy-M-d"


def signup_date(text: Column) -> Column:
    """Either known format; NULL where neither fits."""
    return F.coalesce(F.try_to_date(text, ISO), F.try_to_date(text, DAY_FIRST))


def strict_date(df: DataFrame, column: str) -> Column:
    """ISO date that fails the job on a bad value; a column that is a date already is left alone."""
    if isinstance(df.schema[column].dataType, DateType):
        return F.col(column)
    return F.to_date(F.col(column), ISO)


def coerced_date(df: DataFrame, column: str) -> Column:
    """ISO date, NULL on a bad value; a column that is a date already is left alone."""
    if isinstance(df.schema[column].dataType, DateType):
        return F.col(column)
    return F.try_to_date(F.col(column), LENIENT_ISO)


def month_start(date: Column) -> Column:
    """First day of the month. Grouping on it is cheaper than on the label: a 4-byte key."""
    return F.trunc(date, "month")


def month_label(date: Column) -> Column:
    return F.coalesce(F.date_format(date, MONTH), F.lit(NO_MONTH))
