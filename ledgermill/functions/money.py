"""Amounts as exact decimals: a text that the money type cannot hold as written is never rounded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgermill.schemas import MONEY

#: Holds every amount that fits the money type, with more decimals than any extract writes; texts
#: with still more are told apart by their digits.
_EXACT = "decimal(38,18)"
_FINER = r"\.\d{18}0*[1-9]"


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, StringType)


def survives(text: Column) -> Column:
    """Whether a text is a number that the money type holds exactly; false for NULL."""
    same = text.try_cast(_EXACT) == text.try_cast(MONEY)
    return F.coalesce(same & ~text.rlike(_FINER), F.lit(False))


def strict_money(df: DataFrame, column: str) -> Column:
    """The amount; any text that does not survive fails the job. A column that is no text is cast."""
    text = F.col(column)
    if not _is_text(df, column):
        return text.cast(MONEY)
    problem = F.concat(F.lit(f"{column} is not {MONEY.simpleString()}: "), text)
    fits = text.isNull() | survives(text)
    return F.when(fits, text.try_cast(MONEY)).otherwise(F.raise_error(problem).cast(MONEY))


def coerced_money(df: DataFrame, column: str) -> Column:
    """The amount, NULL where the text does not survive."""
    text = F.col(column)
    if not _is_text(df, column):
        return text.cast(MONEY)
    return F.when(survives(text), text.try_cast(MONEY))


def is_bad_money(df: DataFrame, column: str) -> Column:
    """Whether there is a text that does not survive."""
    text = F.col(column)
    return text.isNotNull() & ~survives(text) if _is_text(df, column) else F.lit(False)
