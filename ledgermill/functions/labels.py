"""Texts of the metric cards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(amount: Column, decimals: int = 0) -> Column:
    """``$1,234`` (half to even)."""
    return F.concat(F.lit("$"), F.format_number(amount, decimals))


def count(n: Column) -> Column:
    """``1,234``"""
    return F.format_number(n, 0)


def percent(rate: Column) -> Column:
    """``17.1%``"""
    return F.concat(rate.cast("string"), F.lit("%"))
